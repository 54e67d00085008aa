"""Token files, centroid clustering and conversation repair, against plain versions."""

import itertools
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repotide.llm import centroids, conversations, queries, token_files
from repotide.llm.common import table, tokenizer_path
from repotide.session import fresh_dir

SF = "/root/testdata/sf0.001"
VOCABULARY = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(VOCABULARY))


# --- token files


def test_blocks_come_back():
    rng = np.random.default_rng(0)
    blocks = [
        np.array([5]), np.zeros(4096), rng.integers(0, 50_000, 4096), np.arange(31), rng.integers(0, 3, 4000),
        np.full(4096, 65535), np.tile(rng.integers(0, 50_000, 700), 5), (rng.zipf(1.4, 4096) % 50_000),
    ]
    blocks = [b.astype(np.uint32) for b in blocks]
    coded = token_files.encode_blocks(blocks)
    found = token_files.decode_blocks(coded, [len(b) for b in blocks])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, blocks))
    # Repetition and skew are predicted: far below the two bytes of an id.
    assert len(coded[1]) < 200 and len(coded[6]) < 0.5 * 2 * 3500 and len(coded[7]) < 0.6 * 2 * 4096


@given(st.lists(st.lists(st.integers(0, 2**27), min_size=1, max_size=80), min_size=1, max_size=6))
@settings(max_examples=40, deadline=None)
def test_any_blocks_come_back_alone_and_together(lists):
    blocks = [np.array(b, np.uint32) for b in lists]
    coded = token_files.encode_blocks(blocks)
    for i, (block, one) in enumerate(zip(blocks, coded)):
        assert token_files.decode_blocks([one], [len(block)])[0].tolist() == block.tolist()
    assert [b.tolist() for b in token_files.decode_blocks(coded, [len(b) for b in blocks])] == lists


def test_damage_is_found():
    blocks = token_files._cut(np.arange(9000, dtype=np.uint32) % 700)
    segment = token_files._pack([4000, 5000], blocks, token_files.encode_blocks(blocks))
    (lengths, ids), = token_files.unpack_all([segment])
    assert lengths.tolist() == [4000, 5000] and ids.tolist() == (np.arange(9000) % 700).tolist()
    for at in (0, 6, 30, 60, len(segment) // 2, len(segment) - 1):
        bad = bytearray(segment)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            list(token_files.unpack_all([bytes(bad)]))
    with pytest.raises(ValueError):
        list(token_files.unpack_all([segment[:-2]]))


def test_a_block_is_coded_alike_beside_any_others():
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.3, n) % 40_000 for n in rng.integers(1, 4097, 150)]
    blocks[7] = blocks[7] + 70_000
    blocks = [b.astype(np.uint32) for b in blocks]
    coded = token_files.encode_blocks(blocks)
    assert [token_files.encode_blocks([b])[0] for b in blocks[:12]] == coded[:12]
    found = token_files.decode_blocks(coded, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(found, blocks))


def test_carries_run_through_the_words():
    coder = token_files._Coder(2)
    top = token_files.TOTAL - 1
    for _ in range(40):
        coder.code(np.array([top, 0], np.uint32), np.array([1, 1], np.uint32))
    coder.code(np.array([top, top], np.uint32), np.array([1, 1], np.uint32))
    reader = token_files._Reader(coder.finish())
    for k in range(41):
        part = reader.range >> 24
        value = reader.value // part
        assert value.tolist() == [top, top if k == 40 else 0]
        reader.narrow(part, value, np.ones(2, np.int64))


def test_blocks_in_step_are_not_halved():
    # Segments end with a document, so that a group is a little over its size.
    assert token_files._groups(token_files.LANES + 16) == [(0, token_files.LANES + 16)]
    for n in (1, 1000, 1535, 1536, 5000):
        edges = token_files._groups(n)
        assert edges[0][0] == 0 and edges[-1][1] == n and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
        assert max(b - a for a, b in edges) <= 1.5 * token_files.LANES


def test_each_different_word_is_encoded_once(library):
    words = token_files.Words(tokenizer_path(VOCABULARY))
    seen, quick = [], words.encoder.quick
    # The encoder is the worker's own.
    words.encoder.quick = lambda text: seen.append(text) or quick(text)
    try:
        texts = ["one two", "two\none two, two,", None, "", "one"] * 30
        ids, sizes = words.encode(pa.array(texts), 0)
        words.encode(pa.array(texts), 0)
    finally:
        words.encoder.quick = quick
    expected = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert ids.tolist() == list(itertools.chain(*expected)) and sizes.tolist() == [len(e) for e in expected]
    # A word after a line feed is another one than after a blank.
    assert [sorted(s.split(" ")) for s in seen if s] == [["", "\none", "\ntwo", "two", "two,"]]


PARTS = [" ", "\n", "a", "The", "É", "’", "22", "'s", ".", ",", "\xa0", "\t", "<|endoftext|>", "ŵ", "x" * 401, "\r\n",
         "(", "_", "ß", "日本", "  ", "\x1c", "##", "\0", "͸"]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_texts_together_are_encoded_as_the_library_does(library, texts):
    words = token_files.Words(tokenizer_path(VOCABULARY))
    for some in (texts, texts[::-1]):
        ids, sizes = words.encode(pa.array(some), 0)
        expected = [library.encode(t, add_special_tokens=False).ids + [0] for t in some]
        assert ids.tolist() == list(itertools.chain(*expected)) and sizes.tolist() == [len(e) for e in expected]


def odd_docs(spark):
    return spark.createDataFrame(
        [(7, "one two"), (3, None), (None, "no id"), (3, ""), (3, "again"), (3, "again"), (-2, "ünï ✓ ͸"),
         (9, "<|endoftext|> !!"), (10, "a " * 40_000), (11, "x" * 9000)],
        "doc_id long, text string",
    ).selectExpr("doc_id", "text", "1 as part", "'x' as start", "2.0 as ids", "3 as n_ids")


def test_token_files_of_odd_rows(spark, library):
    path = fresh_dir(spark, "ids")
    token_files.write(odd_docs(spark), path, tokenizer_path(VOCABULARY))
    found = token_files.read(spark, path).collect()
    expected = sorted(
        (r.doc_id is not None, r.doc_id or 0, library.encode(r.text or "", add_special_tokens=False).ids + [0])
        for r in odd_docs(spark).collect()
    )
    got = sorted(
        (r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in found
    )
    assert got == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert in_order[0] is None and in_order[1:] == sorted(in_order[1:])


def test_token_files_of_an_empty_table(spark):
    path = fresh_dir(spark, "ids")
    token_files.write(odd_docs(spark).limit(0), path, tokenizer_path(VOCABULARY))
    assert token_files.read(spark, path).collect() == []


def test_the_query_of_token_files(spark, library):
    rows = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    expected, at = [], 0
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        expected.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, queries.op11_token_files(spark, SF).collect())) == expected


# --- centroid clustering


def plain_clusters(rows, k=16, rounds=3, width=64, scale=64):
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid)`` by Python's numbers."""
    import math

    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v], v))
    by_hash = sorted(kept, key=lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest(), r[2]))
    means = [v for _, v, _ in by_hash[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        means = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else m for n, m in enumerate(means)]
    found = [(i, *nearest(v)) for i, v, _ in kept]
    total = sum(d for _, d, _ in found)
    inertia = {}
    for _, d, n in found:
        inertia[n] = inertia.get(n, 0) + d

    def fit(x):
        return x if x < 1 << 63 else None

    return [(i, n, fit(d), fit(inertia[n]), fit(total), ",".join(map(str, means[n]))) for i, d, n in found]


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_a_hilbert_curve_visits_neighbours():
    points = np.array(list(itertools.product(range(8), repeat=3)))
    places = centroids.hilbert(points, 3)
    assert sorted(places.tolist()) == list(range(512))
    path = points[np.argsort(places)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_boxes_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    kept = 0
    for _ in range(200):
        x = rng.integers(-30, 30, (20, 4)) + rng.integers(-200, 200, 4)
        means = rng.integers(-200, 200, (9, 4))
        left = centroids.box_candidates(x.min(axis=0), x.max(axis=0), means)
        exact = ((x[:, None] - means) ** 2).sum(axis=2).argmin(axis=1)
        assert set(exact) <= set(left)
        kept += len(left)
    assert kept < 0.5 * 200 * 9


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return frame.selectExpr("vec_id", "embedding", "'x' as v", "1 as place", "2 as cluster", "3 as hash")


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(5, 64))
    rows = [(i, (middle[i % 5] + 0.2 * rng.normal(size=64)).tolist()) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [1.0] * 63 + [None]),
             (305, [float("nan")] + [0.0] * 63), (306, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (5, [0.5] * 64)]
    rows += [(400, rows[7][1])] * 40
    found = centroids.cluster(vectors(spark, rows)).collect()
    assert by_row(found) == by_row(plain_clusters(rows))


def test_clusters_of_huge_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(40)]
    rows += [(100, [2.0**41] + [0.0] * 63), (101, [-3e9] * 64), (102, [1e30] + [1.0] * 63), (103, [3.4e38] * 64), (104, [-1e25] * 64)]
    found = centroids.cluster(vectors(spark, rows)).collect()
    assert by_row(found) == by_row(plain_clusters(rows))


def test_clusters_of_few_rows_and_none(spark):
    rows = [(1, [0.0] * 64), (2, [0.0] * 64), (3, [1.0] * 64)]
    assert by_row(centroids.cluster(vectors(spark, rows)).collect()) == by_row(plain_clusters(rows))
    assert centroids.cluster(vectors(spark, rows).limit(0)).collect() == []


# --- conversation repair

def plain_repairs(codes, limit):
    """All audits of at most ``limit`` insertions that give an allowed sequence, with their costs."""
    import re

    def audits(i, out, audit, cost, inserted):
        if i == len(codes) and re.fullmatch("(s?(ua)+)?", out):
            yield cost, audit
        if inserted < limit:
            for role in "ua":
                yield from audits(i, out + role, audit + "I", cost + 5, inserted + 1)
        if i < len(codes):
            initial, fault = codes[i]
            yield from audits(i + 1, out, audit + "D", cost + 2, inserted)
            if fault not in "bd":
                extra = 5 if fault == "t" else 0
                yield from audits(i + 1, out + initial, audit + "K", cost + extra, inserted)
                for role in "ua":
                    yield from audits(i + 1, out + role, audit + "R", cost + 1 + extra, inserted)

    return min(audits(0, "", "", 0, 0))


def coded(pairs):
    return bytes(conversations.INITIALS.index(i) * 4 + conversations.FAULTS.index(f) for i, f in pairs)


pairs = st.tuples(st.sampled_from("sua?"), st.sampled_from(" bdt"))


@given(st.lists(pairs, max_size=5))
@settings(max_examples=150, deadline=None)
def test_the_cheapest_repair(messages):
    assert conversations.cheapest(coded(messages)) == plain_repairs(messages, 3)


@given(st.lists(pairs, min_size=3, max_size=40), st.integers(1, 7))
@settings(max_examples=150, deadline=None)
def test_spans_make_no_difference(messages, span):
    whole = conversations.cheapest(coded(messages))
    before, conversations.SPAN = conversations.SPAN, span
    try:
        assert conversations.cheapest(coded(messages)) == whole
    finally:
        conversations.SPAN = before


def test_long_conversations_take_linear_time():
    import time

    rng = np.random.default_rng(4)
    codes = bytes((rng.integers(0, 4, 20_000) * 4 + rng.choice([0, 0, 0, 1, 2, 3], 20_000)).tolist())
    start = time.perf_counter()
    _, audit = conversations.cheapest(codes)
    assert time.perf_counter() - start < 30 and sum(c != "I" for c in audit) == 20_000


def messages(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "1 as step", "'x' as edit", "2 as place", "'y' as fault", "3 as code", "4 as kind")


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"), (1, 1, "assistant", "Yes?"), (1, 2, "user", " \t"),
        (2, 5, "assistant", "no user."), (2, None, "system", "Be kind."), (2, None, None, "who?"), (2, 9, "user", "cut"),
        (3, 0, "system", "Alone."), (None, 0, "user", "A."), (None, 1, "assistant", None), (4, None, "", "x!"),
        (5, 0, "user", "same."), (5, 4, "user", "same."), (5, 7, "assistant", "ok." + " " * 5000),
    ]
    script = conversations.repair(messages(spark, rows))
    found = {r["conv_id"]: r for r in conversations.report(script, messages(spark, rows)).collect()}
    assert len(found) == 6

    def told(key):
        return tuple(found[key][c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"))

    assert told(1) == (0, 1, 1, 0, 1, 4, "KKDD", "user:Hi.\nassistant:Yes?")
    # In the order of turn, role, text: " ", system, assistant, user.
    # In the order of turn, role and text: who?, Be kind., no user., cut
    assert told(2)[:7] == (3, 0, 0, 1, 2, *plain_repairs([("?", " "), ("s", " "), ("a", " "), ("u", "t")], 3))
    assert told(3)[5:] == (2, "D", "")
    assert told(None) == (0, 1, 0, 0, 0, 4, "DD", "")
    assert told(4)[0] == 0 and told(4)[6] == "D"
    assert told(5) == (5, 0, 1, 0, 1, 2, "KDK", "user:same.\nassistant:ok." + " " * 5000)
    empty = messages(spark, rows).limit(0)
    assert conversations.report(conversations.repair(empty), empty).collect() == []


def plain_report(spark, sf):
    """The whole query, conversation by conversation, in Python."""
    import re

    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    by_conv = {}
    for conv, turn, role, text in rows:
        kept = by_conv.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes = set(), []
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else " "
            seen.add((role, text))
            codes.append((role[:1], fault))
        cost, audit = conversations.cheapest(coded([(i if i in ("s", "u", "a") else "?", f) for i, f in codes]))
        at, lines = 0, []
        for edit in audit:
            before = lines[-1][0] if lines else ""
            made = "assistant" if before == "user" else "user"
            if edit == "I":
                lines.append((made, ""))
                continue
            _, role, text = own[at]
            at += 1
            if edit != "D":
                lines.append((role if edit == "K" else made, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = "".join(f for _, f in codes)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        repaired = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (gaps, firsts.count("b"), firsts.count("d"), firsts.count("t"), illegal, cost, audit,
                     sha256(repaired.encode()).hexdigest())
    return out


def test_the_query_of_conversations(spark):
    found = queries.op13_conversations(spark, SF)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == plain_report(spark, SF)
    assert found.select(F.countDistinct("conv_id")).first()[0] == found.count()


def test_rows_of_a_conversation_are_shuffled_once_before_the_agenda(spark):
    plan = conversations.repair(table(spark, SF, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_script_row_for_each_edit(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Go on")]
    script = conversations.repair(messages(spark, rows)).orderBy("step").collect()
    audit = conversations.cheapest(coded([("a", " "), ("u", "t")]))[1]
    assert "".join(r["edit"] for r in script) == audit
    assert [r["step"] for r in script] == list(range(len(audit)))
    assert sum(r["cost"] for r in script) == plain_repairs([("a", " "), ("u", "t")], 3)[0]
