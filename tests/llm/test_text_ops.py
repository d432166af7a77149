import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.decontaminate import contamination
from corvid.llm.exact_dedup import exact_duplicates
from corvid.llm.line_dedup import removed_lines, without_lines
from corvid.llm.minhash_dedup import SYMBOLS, index_keys, near_duplicates
from tests.llm import corpus as c

ROWS = c.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return c.frame(spark, ROWS).repartition(3).cache()


def test_words_and_shingles_match_plain_python():
    import pyarrow as pa
    texts = [t for _, t in ROWS]
    for lo, hi, raw, off in tn.slices(pa.array(texts), 1000):
        h, start, end, counts = tn.words(raw, off, tn.NOT_BLANK)
        for i in range(lo, hi):
            assert counts[i - lo] == len(c.tokens(texts[i])) - 1
        _, sizes = tn.word_shingles(h, counts, 5)
        assert list(sizes) == [len(c.shingles(t)) for t in texts[lo:hi]]
    # equal words have equal hashes wherever they stand, different ones differ
    words = sorted({w for t in texts for w in c.tokens(t)[:-1]})
    a = pa.array([" ".join(words) + " " + " ".join(reversed(words))])
    _, _, raw, off = next(tn.slices(a))
    h = tn.words(raw, off, tn.NOT_BLANK)[0]
    assert (h[:len(words)] == h[len(words):][::-1]).all() and len(set(h)) == len(words)


@pytest.mark.parametrize("digest", [None, lambda x: F.unhex(F.lpad(F.hex(F.crc32(x) % 3), 2, "0"))])
def test_exact_dedup(docs, digest):
    """With a three-valued digest nearly everything collides; content still decides."""
    out = exact_duplicates(docs, **({"digest": digest} if digest else {})).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault("".join(ch for ch in t or "" if ch not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g)) for g in groups.values() for _, i in g}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in out} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out) and len(out) == len(ROWS)


def test_exact_dedup_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (3, "ab"), (3, "ab"), (None, None), (-5, "")]
    out = exact_duplicates(c.frame(spark, rows)).collect()
    # the longest text wins even without an id; the two rows of document 3 go alike
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out))) == sorted(map(str, [
        (None, None, 3, True), (3, None, 3, False), (3, None, 3, False), (None, -5, 2, False), (-5, -5, 2, True)]))


def test_near_duplicates(docs):
    out = near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == c.components(ROWS)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(ROWS)


def test_index_finds_all_within_the_guaranteed_distance():
    r = np.random.default_rng(0)
    a = r.integers(0, 1 << 16, (200, SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for i in range(200):  # 15 of 32 symbols changed, anywhere
        b[i, r.permutation(SYMBOLS)[:15]] ^= 1
    ka, kb = index_keys(a), index_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka, kb))


def test_near_duplicates_large_group_of_near_copies(spark):
    """More near copies than one block holds: found through block pairs, against brute force."""
    import random
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 6])):
            w[r.randrange(60)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    from corvid.llm import minhash_dedup as m
    old = m.BLOCK, m.SET_BLOCK
    m.BLOCK, m.SET_BLOCK = 64, 50
    try:
        out = near_duplicates(c.frame(spark, rows)).collect()
    finally:
        m.BLOCK, m.SET_BLOCK = old
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == c.components(rows)


def test_line_dedup(docs):
    out = {}
    for r in removed_lines(docs).collect():
        out.setdefault(r.doc_id, []).append(r.line_no)
    want = c.removed(ROWS)
    assert {k: sorted(v) for k, v in out.items()} == dict(want)
    clean = {r.doc_id: r for r in without_lines(docs, removed_lines(docs)).collect()}
    for i, t in ROWS:
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want.get(i, []))
        assert clean[i].text == left and clean[i].source == "s"


def test_line_dedup_tells_words_with_equal_32_bit_hashes_apart(spark):
    """Template lines that differ in one word are unique, also where Spark's hash() of the words is the same."""
    alike = (spark.range(400_000).selectExpr("concat('id', id) AS w").groupBy(F.hash("w"))
             .agg(F.collect_list("w").alias("w")).filter("size(w) > 1").collect())
    assert alike
    rows = [(2 * i + k, f"order number {w} was sent today") for i, r in enumerate(alike) for k, w in enumerate(r.w[:2])]
    assert removed_lines(c.frame(spark, rows)).count() == 0


def test_line_dedup_of_every_line(spark):
    """Short lines, lines cut by other white space than blanks, and lines of a script without blanks."""
    han = "".join(chr(0x4E00 + 7 * k) for k in range(40))
    same = ["Read more", "x", "one\ttwo\tthree\tfour\tfive", "eins\u00a0zwei", han]
    rows = [(1, "\n".join(same)), (2, "\n".join(same)), (3, "one two three four five\n\n \t\n\u00a0\nread more\neins  zwei"),
            (4, "\n\n \t\n" + han[:-1] + "\n" + han[::-1] + "\nserial-100001"), (5, "serial-100002")]
    out = {}
    for r in removed_lines(c.frame(spark, rows)).collect():
        out.setdefault(r.doc_id, {})[r.line_no] = r.reason
    assert out == {2: dict.fromkeys(range(5), "exact"), 3: {0: "exact", 5: "exact"}, 4: {3: "similar"}}


def test_line_dedup_of_odd_rows(spark):
    """Null ids are one document after all others; repeated rows lose the same lines; long lines take part."""
    long = " ".join(f"w{k}" for k in range(20000))
    rows = [(None, "alpha beta\nx"), (None, "y\nalpha beta"), (3, "alpha beta"), (5, "z\nz"), (5, "z\nz"),
            (6, None), (7, ""), (8, long), (9, "first " + long)]
    out = {(r.doc_id, r.line_no, r.reason) for r in removed_lines(c.frame(spark, rows)).collect()}
    assert out == {(None, 0, "exact"), (None, 1, "exact"), (5, 1, "exact"), (9, 0, "similar")}


def test_line_dedup_without_broadcasts(docs, monkeypatch):
    """Beyond the bound of a broadcast the joins are shuffle joins with the same rows."""
    from corvid.llm import line_dedup as ld
    want = sorted(map(tuple, removed_lines(docs).collect()))
    monkeypatch.setattr(ld, "MAX_SENT", 0)
    assert sorted(map(tuple, removed_lines(docs).collect())) == want and want


def test_line_dedup_in_waves(docs, monkeypatch):
    """The prefix tokens are shuffled in waves; their number changes no row, and no token is left out."""
    from corvid.llm import line_dedup as ld
    want = sorted(map(tuple, removed_lines(docs).collect()))
    for waves in (1, 3):
        monkeypatch.setattr(ld, "WAVES", waves)
        assert sorted(map(tuple, removed_lines(docs).collect())) == want and want


def test_sets_go_only_with_tokens_that_are_asked_for(spark):
    """Of a partner's postings those are joined with its full set whose token a line asks for."""
    from corvid.llm import line_dedup as ld
    bits = {f"b{k}": 0 for k in range(ld.BITMAP_WORDS)}

    def posting(d, i, token):
        return {"d": d, "line_no": 0, "k1": d, "n": 3, "i": i, "token": token, **bits}
    kind = "d long, line_no int, k1 long, n int, i int, token long, " + ", ".join(f"{b} long" for b in bits)
    asking = spark.createDataFrame([posting(2, 0, 5)], kind)
    partners = spark.createDataFrame([posting(1, 0, 5), posting(1, 1, 6), posting(3, 0, 7)], kind)
    sets = spark.createDataFrame([(d, 0, d, [1, 2, 3]) for d in (1, 2, 3)], "d long, line_no int, k1 long, s array<long>")
    out = ld._similar(asking, partners, sets, 75)
    assert [r.d for r in out.collect()] == [2]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2, plan  # the asked tokens, and the similar lines


def test_line_dedup_of_repeated_shingles_and_places(spark):
    """Lines with repeated shingles, and different lines at one place (repeated and null ids), against all pairs."""
    words = [f"w{k}" for k in range(12)]
    rows = [(1, " ".join(words * 3)), (2, " ".join(words * 4)), (2, " ".join(words + words[:6])), (3, "a " * 9), (4, "a " * 12),
            (None, " ".join(reversed(words))), (None, " ".join([*reversed(words), "x"])), (5, " ".join(words[::2]))]
    out = {(r.doc_id, r.line_no, r.reason) for r in removed_lines(c.frame(spark, rows)).collect()}
    # both lines of document 2 are at place (2, 0); those without an id share a place, so none is earlier
    assert out == {(2, 0, "similar"), (4, 0, "similar")}


def test_stored_tables_leave_no_shuffle_files(spark):
    """The files of a shuffle go with the write of the table it makes; the session's setting stays."""
    from corvid.llm import common

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size())}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    out = common.stored(spark.range(5000).repartition(3, "id"), "shuffled")
    assert not [x for x in files() - before if x.startswith("shuffle_")]
    assert out.count() == 5000 and spark.conf.get(name) == setting


def test_contamination(spark, docs):
    long = max((t or "" for _, t in ROWS), key=len).split(" ")
    items = [(1, " ".join(long[100:140])), (2, " ".join(long[130:150]).upper()), (3, "one"), (4, None), (5, ""), (6, "?!"),
             (7, " ".join(reversed(long[:30]))), (1, " ".join(long[100:140]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = contamination(docs, bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in out} == c.contamination(ROWS, items)


def test_contamination_in_benchmark_blocks_and_proximity(spark):
    text = [f"w{i}" for i in range(40)]
    near = text[:20] + ["extra"] + text[20:]
    rows = [(1, " ".join(text)), (2, " ".join(near)), (3, " ".join(text[:18] + ["gap"] * 3 + text[18:])), (4, None)]
    bench = spark.createDataFrame([(9, " ".join(text[10:30])), (8, "w1 w2")], "item_id long, text string")
    from corvid.llm.decontaminate import build_index, find_matches
    index = build_index(c.frame(spark, rows))
    whole = find_matches(index, bench).collect()
    parts = find_matches(index, bench, block_words=5).collect()  # several blocks: the same matches
    assert sorted(whole) == sorted(parts)
    out = {r.doc_id: r for r in contamination(c.frame(spark, rows), bench).collect()}
    assert out[1]["items"] == ["8", "9"] and out[2]["items"] == ["8"] and out[2].n_near_items == 1
    assert out[3].n_near_items == 0 and out[4].n_words == 0


@pytest.mark.parametrize("op", [exact_duplicates, near_duplicates, removed_lines,
                                lambda d: contamination(d, d.sparkSession.createDataFrame([], "item_id long, text string"))])
def test_empty_table(spark, op):
    assert op(c.frame(spark, [])).count() == 0


def _with_sql():
    from corvid.llm.queries import ORACLES
    return sorted(ORACLES)


@pytest.mark.parametrize("name", _with_sql())
def test_query_matches_its_sql(spark, name):
    import os
    import sys
    from types import SimpleNamespace
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from check_oracle import compare, duck

    from corvid.llm.queries import ORACLES, QUERIES
    sf = "/root/testdata/sf0.001"
    r = compare(spark, duck(sf), name, SimpleNamespace(build=QUERIES[name], sql=ORACLES[name]), sf)
    assert r["status"] == "ok", r


def test_contract_query_columns(spark):
    from corvid.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    want = {"op2": "doc_id n_words n_hit n_items items_sha256 contaminated", "op3": "doc_id keep_id group_size kept text_sha256",
            "op4": "doc_id piece start length ids_crc32 sequence_id offset", "op5": "doc_id held_out score predicted",
            "op6": "doc_id n_assign n_access n_hex base_sha256 spans", "op8":
            "doc_id held_out n_tokens n_known train_tokens base_score score",
            "op10": "doc_id n_shingles component_id kept"}
    for name, build in QUERIES.items():
        cols = want.get(name.split("_")[0])
        if cols and name.split("_")[0] in ("op2", "op3", "op6"):
            assert build(spark, sf).columns[:len(cols.split())] == cols.split()
    assert zlib.crc32(b"0") % 5 >= 0
