"""Counters of a crawl, told by the run itself: no row is read again to be counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Watches tables on their way; :meth:`totals` is complete after the last action."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}
        self._known: dict[str, int] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, whose rows are counted when they are made the first time."""
        self._watched[name] = Observation()
        return df.observe(self._watched[name], F.count(F.lit(1)).alias("n"))

    def slices(self, requested: DataFrame, missing: DataFrame) -> None:
        """The manifest's part: how many slices are produced, and how many are stored."""
        total, absent = requested.distinct().count(), missing.count()
        self._known |= {"slices_from_api": absent, "slices_from_cache": total - absent}

    def totals(self) -> dict[str, int]:
        """Rows fetched, loaded, written and emitted, repeats inside slices and of other slices."""
        # Without slices to produce, or stored ones, the planner drops that part and its count.
        none = {"slices_from_api": ("fetched", "written_to_cache"), "slices_from_cache": ("loaded_from_cache",)}
        empty = {name for known, names in none.items() if self._known.get(known) == 0 for name in names}
        seen = {name: 0 if name in empty else watched.get["n"] for name, watched in self._watched.items()}
        fetched, loaded = seen.get("fetched", 0), seen.get("loaded_from_cache", 0)
        written = seen.get("written_to_cache", 0)
        repeats = fetched - written if "written_to_cache" in seen else 0
        emitted = seen.get("unique", 0)
        return {
            **self._known,
            "fetched": fetched,
            "loaded_from_cache": loaded,
            "written_to_cache": written,
            "duplicate_in_slice": repeats,
            "duplicate_global": fetched - repeats + loaded - emitted,
            "emitted": seen.get("emitted", emitted),
        }
