"""Cheapest repair of conversations by Knuth's agenda over weighted deductions.

A conversation is a row of messages. ``Ready(i, q)`` says that the messages
before the i-th are dealt with and the roles put out so far leave the grammar in
state ``q``; ``Row(i)`` is the i-th message, an axiom. A deduction joins the two
to keep, rerole or delete the message, another inserts one; ``Goal`` follows from
a state in which the grammar may end. The value of an item is its (cost, audit),
the audit being the initials of the edits in order. Every deduction adds a cost
and at most one initial at the end, so its function is superior: no conclusion
is less than an antecedent, the agenda pops items in ascending order, and what it
pops is final.

A long conversation is dealt with in spans of messages. What one span passes to
the next are the final items after its last message, one for each state. Their
audits have equally many initials of messages and end in one, so none is the
beginning of another, and their order alone decides later ties.

Spark numbers the messages of each conversation, marks their faults, and brings
them to the agenda twice, in order: first a code per message, from which it finds
the audit, then the messages themselves, which stream past. So a task holds a few
bytes per message of one conversation, and no texts. All messages of a
conversation do pass through one task, as its edits are one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.llm.common import prepare

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Messages that one agenda deals with.
SPAN = 256

# Fixed values of the grammar ``(s?(ua)+)?``: states are "nothing yet" and the last initial.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ENDS = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
ROLES = {USER: "user", ASSISTANT: "assistant"}
WHITE = " \t\n\x0b\x0c\r"

# A message's code: its initial, and its fault.
INITIALS, FAULTS = "sua?", " bdt"
SCRIPT = (
    "conv_id long, step long, edit string, cost long, turn long, role string, text string, "
    "fault string, illegal boolean, first_of_turn boolean"
)


def _deductions(codes: bytes, last: bool):
    """Conclusions of a final item, given what is final: (conclusion, antecedent, cost, initial)."""

    def of_row(i: int, q: int, ready: tuple):
        initial, fault = INITIALS[codes[i] >> 2], FAULTS[codes[i] & 3]
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            if q in STEPS.get(initial, ()):
                yield ("Done", i + 1, STEPS[initial][q]), ready, KEEP + extra, "K"
            for role in "ua":
                if q in STEPS[role]:
                    yield ("Done", i + 1, STEPS[role][q]), ready, REROLE + extra, "R"
        yield ("Done", i + 1, q), ready, DELETE, "D"

    def conclude(item: tuple, final: dict):
        kind, i, q = item
        if kind == "Row":
            for state in range(4):
                if ("Ready", i, state) in final:
                    yield from of_row(i, state, ("Ready", i, state))
        elif kind == "Ready":
            if ("Row", i, 0) in final:
                yield from of_row(i, q, item)
            for role in "ua":
                if q in STEPS[role]:
                    yield ("Ready", i, STEPS[role][q]), item, INSERT, "I"
            if last and i == len(codes) and q in ENDS:
                yield ("Goal", i, 0), item, 0, ""
        elif kind == "Done" and (last or i < len(codes)):
            yield ("Ready", i, q), item, 0, ""

    return conclude


def lightest(codes: bytes, entries: dict[int, tuple[int, int]], last: bool) -> dict[tuple, tuple[int, int, str]]:
    """Final values ``(cost, rank, audit)`` of the goal, or of the items behind the last message.

    ``entries`` has cost and rank of the audits so far, for each state.
    """
    conclude = _deductions(codes, last)
    agenda: list[tuple[int, int, str, tuple]] = [(0, -1, "", ("Row", i, 0)) for i in range(len(codes))]
    for state, (cost, rank) in entries.items():
        heappush(agenda, (cost, rank, "", ("Ready", 0, state)))
    final: dict[tuple, tuple[int, int, str]] = {}
    wanted = {("Goal", len(codes), 0)} if last else {("Done", len(codes), q) for q in range(4)}
    while agenda and wanted:
        cost, rank, audit, item = heappop(agenda)
        if item in final:
            continue
        final[item] = cost, rank, audit
        wanted.discard(item)
        for conclusion, antecedent, weight, initial in conclude(item, final):
            if conclusion not in final:
                before, rank, audit = final[antecedent]
                heappush(agenda, (before + weight, rank, audit + initial, conclusion))
    kind = "Goal" if last else "Done"
    return {item: value for item, value in final.items() if item[0] == kind and item[1] == len(codes)}


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the best repair of a whole conversation."""
    entries = {START: (0, 0)}
    sources = [START]
    trail: list[dict[int, tuple[int, str]]] = []  # per span: exit state -> entry state, audit
    spent = 0
    for at in range(0, max(len(codes), 1), SPAN):
        last = at + SPAN >= len(codes)
        found = lightest(codes[at : at + SPAN], entries, last)
        ordered = sorted(found.items(), key=lambda pair: pair[1][1:])
        trail.append({item[2]: (sources[rank], audit) for item, (_, rank, audit) in ordered})
        least = min(cost for cost, _, _ in found.values())
        spent += least
        entries = {item[2]: (cost - least, i) for i, (item, (cost, _, _)) in enumerate(ordered)}
        sources = [item[2] for item, _ in ordered]
    state, parts = 0, []
    for exits in reversed(trail):
        state, audit = exits[state]
        parts.append(audit)
    return spent, "".join(reversed(parts))


_remembered = lru_cache(1 << 16)(cheapest)


class _Script:
    """Rows of the edit script, of a batch of messages."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch = batch
        self.at: list[int] = []
        self.source: list[int | None] = []
        self.steps: list[int] = []
        self.edits: list[str] = []
        self.costs: list[int] = []
        self.roles: list[str | None] = []

    def add(self, at: int, source: int | None, step: int, edit: str, cost: int, role: str | None) -> None:
        for column, value in zip(
            (self.at, self.source, self.steps, self.edits, self.costs, self.roles),
            (at, source, step, edit, cost, role),
        ):
            column.append(value)

    def rows(self) -> pa.RecordBatch:
        own = self.batch.take(pa.array(self.source, pa.int64()))
        texts = own["text"].to_pylist()
        for i, edit in enumerate(self.edits):
            if edit in "DI":
                texts[i] = None if edit == "D" else ""
        fault = [f or "" for f in own["fault"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                self.batch["conv_id"].take(pa.array(self.at, pa.int64())),
                pa.array(self.steps, pa.int64()),
                pa.array(self.edits, pa.string()),
                pa.array(self.costs, pa.int64()),
                own["turn"],
                pa.array(self.roles, pa.string()),
                pa.array(texts, pa.string()),
                pa.array(fault, pa.string()),
                own["illegal"].fill_null(False),
                own["first_of_turn"].fill_null(False),
            ],
            names=["conv_id", "step", "edit", "cost", "turn", "role", "text", "fault", "illegal", "first_of_turn"],
        )


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, audit, reading = bytearray(), "", True
    at = step = state = 0
    for batch in batches:
        script = _Script(batch)
        roles = None
        for i, (kind, code) in enumerate(zip(batch["kind"].to_pylist(), batch["code"].to_pylist())):
            if kind == 0:
                if not reading:
                    codes, reading = bytearray(), True
                codes.append(code)
                continue
            if reading:
                known = _remembered if len(codes) <= 32 else cheapest
                audit = known(bytes(codes))[1]
                reading, at, step, state, row = False, 0, 0, START, 0
            if roles is None:
                roles = batch["role"].to_pylist()

            def insert() -> None:
                nonlocal state, step, at
                while at < len(audit) and audit[at] == "I":
                    state = STEPS["a" if state == USER else "u"][state]
                    script.add(i, None, step, "I", INSERT, ROLES[state])
                    step, at = step + 1, at + 1

            insert()
            edit = audit[at]
            initial, fault = INITIALS[code >> 2], FAULTS[code & 3]
            extra = TRUNCATED if fault == "t" else 0
            if edit == "D":
                script.add(i, i, step, "D", DELETE, None)
            elif edit == "K":
                state = STEPS[initial][state]
                script.add(i, i, step, "K", KEEP + extra, roles[i])
            else:
                state = STEPS["a" if state == USER else "u"][state]
                script.add(i, i, step, "R", REROLE + extra, ROLES[state])
            step, at, row = step + 1, at + 1, row + 1
            if row == len(codes):
                insert()
        if script.at:
            yield script.rows()


def _code(initial: Column, fault: Column) -> Column:
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(fault == "b", 1).when(fault == "d", 2).when(fault == "t", 3).otherwise(0)
    return (place * 4 + kind).cast("int")


def repair(messages: DataFrame) -> DataFrame:
    """The edit script: one row per edit, of ``conv_id`` in the order of ``step``.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns
    are ignored. A null role or text counts as one space; a null ``conv_id`` is a
    conversation of its own; null turns come first. Messages of one turn are
    ordered by role, then text. ``edit`` is D(elete), I(nsert), K(eep) or R(erole);
    ``role`` and ``text`` are those after the edit, null for a deleted message;
    ``turn``, ``fault`` (b, d, t or empty) and ``illegal``, for a pair of roles
    that may not follow each other, describe the message before it.
    ``first_of_turn`` marks one message of each turn that is not null. Empty input
    gives no rows; a conversation whose messages all go has its deletions.
    """
    prepare(messages.sparkSession)
    plain = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = plain.select(
        "*",
        F.row_number().over(order).alias("place"),
        F.lag("role").over(order).alias("role_before"),
        F.lag("turn").over(order).alias("turn_before"),
    )
    # The rows of a conversation are together already.
    same = Window.partitionBy("conv_id", "role", "text").orderBy("place")
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    marked = placed.select(
        "*",
        F.when(end == "", "b")
        .when(F.row_number().over(same) > 1, "d")
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "t")
        .otherwise("")
        .alias("fault"),
        F.coalesce(
            ~F.concat(F.substring("role_before", 1, 1), initial).isin(*LEGAL_PAIRS), F.lit(False)
        ).alias("illegal"),
        F.coalesce(~F.col("turn").eqNullSafe(F.col("turn_before")) & F.col("turn").isNotNull(), F.lit(False)).alias(
            "first_of_turn"
        ),
    )
    twice = marked.select(
        "conv_id", "place", "turn", "fault", "illegal", "first_of_turn", _code(initial, F.col("fault")).alias("code"),
        "role", "text", F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"),
    )
    needed = (F.col("kind") == 1) & ~F.col("fault").isin("b", "d")
    return (
        twice.withColumn("role", F.when(needed, F.col("role")))
        .withColumn("text", F.when(needed, F.col("text")))
        .sortWithinPartitions("conv_id", "kind", "place")
        .mapInArrow(_edit, SCRIPT)
    )


def damage(messages: DataFrame) -> DataFrame:
    """``messages`` with faults made by a checksum of conversation and turn; nulls are one space.

    Of 20 remainders, 0 drops a message, 1 empties its text, 2 takes its sentence
    marks, 3 repeats it and 4 gives it the role of the user.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = shown("text"), shown("role")
    return messages.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def report(script: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``, with counts, cost, audit and repaired text."""
    none = F.lit(None)
    marks = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", *(none.cast(f.dataType).alias(f.name) for f in script.schema.fields[1:])
    )

    def number(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0)).cast("long")

    edits = F.array_sort(
        F.collect_list(
            F.when(
                F.col("edit").isNotNull(),
                F.struct("step", "edit", F.concat("role", F.lit(":"), "text").alias("line")),
            )
        )
    )
    found = script.union(marks).groupBy("conv_id").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.sum(F.col("first_of_turn").cast("long")), F.lit(0)
        ).cast("long").alias("gaps"),
        number(F.col("fault") == "b").alias("blank"),
        number(F.col("fault") == "d").alias("duplicate"),
        number(F.col("fault") == "t").alias("truncated"),
        number(F.col("illegal")).alias("illegal"),
        F.coalesce(F.sum("cost"), F.lit(0)).cast("long").alias("cost"),
        edits.alias("edits"),
    )
    kept = F.filter("edits", lambda e: e["edit"] != "D")
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.col("edits.edit"), "").alias("audit"),
        F.array_join(F.transform(kept, lambda e: e["line"]), "\n").alias("repaired"),
    )
