import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import spark_partition_id

from corvid.llm import common, packing, pitman_yor, quality_knn, toxicity
from corvid.llm.common import stored
from corvid.llm.html_render import render, render_pages
from corvid.llm.packing import fullest, minimum_bin_slack, pack_documents, text_ids
from corvid.llm.pitman_yor import language_model_scores
from corvid.llm.quality_knn import quality_scores
from corvid.llm.queries import tokenizer_path
from corvid.llm.secrets_scan import scan_secrets
from corvid.llm.toxicity import fit_ordinal, severity_scores
from tests.llm import corpus as c

ROWS = c.corpus(2)
EDGE = [(1, None), (2, ""), (3, "x"), (None, "x y"), (3, "x")]
BPE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def docs(spark):
    return c.frame(spark, ROWS).repartition(3).cache()


def held(i, m, k):
    return zlib.crc32(str(i).encode()) % m == k


# -- packing ---------------------------------------------------------------------

def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(BPE))
    r = random.Random(0)
    letters = "abAB01'<|>_.,;éÉßÀÿ×µ \ń日Σ~\x7f\x1c\x85\xa0"
    texts = ["", "it's 12.5 a_b $$$ <|endoftext|> x", "<|startoftext|>", *(t or "" for _, t in ROWS)]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 50))) for _ in range(500)]
    for t, ids in zip(texts, text_ids(tokenizer_path(BPE), texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", range(5))
def test_fullest_is_the_best_subset(seed):
    r = random.Random(seed)
    for _ in range(50):
        slack = r.randint(0, 60)
        available = sorted(((k, r.randint(1, 3)) for k in r.sample(range(1, 40), 5)), reverse=True)
        sums = {0}
        for length, count in available:
            sums = {s + length * j for s in sums for j in range(count + 1)}
        got = fullest(slack, available)
        assert sum(k * u for k, u in got) == max(s for s in sums if s <= slack)
        assert all(u <= dict(available)[k] for k, u in got)


def test_bins_cover_the_pieces_and_are_few():
    r = random.Random(1)
    counts = {}
    for _ in range(20_000):
        n = min(2047, max(1, int(r.lognormvariate(6, 1))))
        counts[n] = counts.get(n, 0) + 1
    bins = minimum_bin_slack(counts)
    used = {}
    for pattern, copies in bins:
        assert sum(k * u for k, u in pattern) <= 2048
        for k, u in pattern:
            used[k] = used.get(k, 0) + u * copies
    assert used == counts
    lower = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert sum(copies for _, copies in bins) <= lower * 1.005 + 1
    assert minimum_bin_slack({}) == []


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(BPE))
    want = []
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(str(i), k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes()))
                 for k in range(0, len(ids), capacity)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_pack_documents(spark, docs):
    check_packing(pack_documents(docs, tokenizer_path(BPE)).collect(), ROWS, 2048)
    check_packing(pack_documents(docs, tokenizer_path(BPE), capacity=64).collect(), ROWS, 64)
    check_packing(pack_documents(c.frame(spark, EDGE), tokenizer_path(BPE)).collect(), EDGE, 2048)
    assert pack_documents(c.frame(spark, []), tokenizer_path(BPE)).count() == 0


def test_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 50)
    t = ROWS[0][1] or "x"
    long = " ".join(w for _, w in ROWS if w)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([long])], ["a", "b"])
    out = pa.Table.from_batches(packing._piece_batches(iter([batch]), tokenizer_path(BPE), 100, 0)).to_pylist()
    ids = text_ids(tokenizer_path(BPE), [long])[0] + b"\0\0\0\0"
    assert [r["ids_crc32"] for r in out] == [zlib.crc32(ids[k:k + 400]) for k in range(0, len(ids), 400)] and t


# -- classifiers -----------------------------------------------------------------

def labelled(spark, n=400):
    r = random.Random(4)
    good = [f"word{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(n):
        w = [r.choice(good) for _ in range(r.randint(5, 60))]
        bad, toxic = i % 5 == 0, i % 4 == 1
        if bad:
            w = [x.upper() + "!!" for x in w]
        if toxic:
            w[r.randrange(len(w))] = r.choice(["awfulness", "awfully", "nasty"])
        texts.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(toxic) + int(toxic and i % 8 == 1)))
    labels += [(None, 1, 1), (10 ** 6, 0, 1), (0, None, None)]
    return (c.frame(spark, texts + [(5000, None), (5001, ""), (None, "word1")]),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_classifier(spark):
    docs, labels = labelled(spark)
    out = quality_scores(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    scored = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(scored) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in scored]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out) and len(out) == 403
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id, 5, 0)) for r in out)
    none = quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and quality_scores(docs.limit(0), labels).count() == 0


def test_quality_never_reads_held_out_labels(spark):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END "
                                "AS quality")
    a = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_scores(docs, flipped).collect()}
    assert a == b


def test_vote_is_the_weighted_share_of_the_nearest():
    z = np.array([[1.0, 0.0]], dtype=np.float32)
    v = np.array([[1, 0], [0.6, 0.8], [0, 1], [-1, 0]], dtype=np.float32)
    assert quality_knn.vote(z, v, np.array([1.0, 0, 0, 0]), 2, 0.5)[0] == pytest.approx(1 / 1.6)


def test_toxicity(spark):
    docs, labels = labelled(spark)
    out = severity_scores(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    scored = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([(r.predicted >= 1) == (truth[r.doc_id] >= 1) for r in scored]) > 0.95
    assert all(0 <= r.severity <= 2 for r in out) and len(out) == 403
    assert {r.severity for r in severity_scores(docs, labels.limit(0)).collect()} == {0.0}
    assert severity_scores(docs.limit(0), labels).count() == 0


def test_ordinal_fit_orders_grades():
    """Four grades on one scale: one shared weight per feature, ascending thresholds, rising expected severity."""
    r = np.random.default_rng(0)
    x = r.random((4000, 3)) < 0.4
    z = x @ np.array([2.0, 1.0, 0.0]) + r.logistic(size=4000)
    grade = np.digitize(z, [0.5, 1.5, 2.5])
    counts = x.sum(axis=1)
    w, theta = fit_ordinal(np.nonzero(x)[1], counts, grade, 4, 3, penalty=0.1, rounds=800)
    assert (np.diff(theta) > 0).all() and w[0] > w[1] > abs(w[2]) and abs(w[0] - 2) < 0.4
    assert np.allclose(theta, [0.5, 1.5, 2.5], atol=0.4)


# -- secrets ---------------------------------------------------------------------

def test_secrets(spark):
    import public_tokenizers
    digest = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    token = "q7Zx0Lr9Tt2Wv5Yk8Bn3Mc6Hd1Fg4Js"
    texts = [f'é token = "{digest}" end', f"key {token} done", "AKIA" + "A1" * 8, "AKIA" + "A" * 13,
             "password: token: abcdefghijklmnop", "PASSWD='short' secret=longenoughvalue1", digest,
             "123e4567-e89b-42d3-a456-426614174000 order-2024-item-17-of-the-list some_long_identifier_name_v2", None, ""]
    out = {r.doc_id: r for r in scan_secrets(c.frame(spark, list(enumerate(texts))), tokenizer_path("byte_bpe_50k.tiktoken"),
                                             public_tokenizers.PATTERN).collect()}
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
             ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0)]
    for i, t in enumerate(texts):
        found = []
        for k, (kind, pattern, flags) in enumerate(kinds):
            for m in re.finditer(pattern, t or "", flags):
                size = len(m.group(2)) if kind == "assign" else len(m.group())
                if size >= (12, 18, 16)[k]:
                    found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        assert out[i].base == ",".join(x for _, _, x in sorted(found)), t
    assert out[1].n_random == 1 and f"random:4:{4 + len(token)}" in out[1].spans
    assert sum(r.n_random for r in out.values()) == 1
    assert hashlib.sha256(out[9].base.encode()).hexdigest().startswith("e3b0c442")


# -- pages -----------------------------------------------------------------------

@pytest.mark.parametrize("page, text", [
    ("", ""), ("a  b\n c", "a b c"), ("<p>one<p>two", "one\n\ntwo"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("x<br>y<br><br>z", "x\ny\n\nz"), ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
    ("<ol start=9><li>x<li>y</ol>", "9. x\n10. y"), ("<pre> a\n  b</pre>", "a\n  b"),
    ("<script>if(a<b)</script>x<style>p{}</style><p hidden>n<p style='display: none'>n</p>y", "xy"),
    ("<table><tr><th>Name<th>Qty<tr><td>fig<td>12</table>", "Name | Qty\nfig  | 12"),
    ("<table><td rowspan=2>r<td>a<tr><td>b</table>", "r | a\n  | b"),
    ("1 < 2 &amp; 3 &lt; 4 <!-- no -->ok", "1 < 2 & 3 < 4 ok"), ("</p></b>y<", "y<"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<a href=\"x>y\">link</a>, <b>bold</b>ly", "link, boldly")])
def test_render(page, text):
    assert render(page) == text


def test_render_deep_and_broken_pages(spark):
    assert render("<div>" * 20_000 + "x") == "x"
    assert render("<table><tr><td>" * 300 + "x").strip(" |") == "x"
    rows = [(1, None), (2, ""), (None, "<p>x"), (1, "<p>x")]
    out = render_pages(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert sorted((str(r.page_id), r.text) for r in out) == [("1", ""), ("1", "x"), ("2", ""), ("None", "x")]
    assert render_pages(spark.createDataFrame([], "page_id long, html string")).count() == 0


# -- language model --------------------------------------------------------------

def test_language_model(docs):
    out = language_model_scores(docs).collect()
    train = c.counts([r for r in ROWS if not held(r[0], 7, 2)])
    n, v = sum(train.values()), len(train)
    text = dict(ROWS)
    assert len(out) == len(ROWS)
    for r in out:
        w = c.tokens(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(train[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w))
        assert r.held_out == held(r.doc_id, 7, 2) and r.score < 0
    assert sum(r.score for r in out if not r.held_out) > sum(r.base_score for r in out if not r.held_out)


def test_language_model_probabilities_sum_to_one(spark, docs, monkeypatch):
    """Over all known types and the unknown one, after each class of token."""
    shards = 3
    held_docs = docs.selectExpr("doc_id", "false AS held_out", "text")
    rows = held_docs.mapInArrow(lambda it: pitman_yor._block_batches(it, shards), pitman_yor._SCHEMA)
    blocks = pa.Table.from_pylist([r.asDict() for r in rows.collect()]).filter(pa.compute.field("shard") >= 0)
    counts = []
    for s in range(shards):
        keys, n = pitman_yor._merged(blocks.filter(pa.compute.field("shard") == s))
        counts.append((s, keys.tobytes(), n.tobytes()))
    m = pitman_yor.fit(spark.createDataFrame(counts, "shard int, keys binary, counts binary"))
    words = [np.unique(np.frombuffer(k, dtype=np.uint64) >> np.uint64(pitman_yor.CLASS_BITS)) for _, k, _ in counts]
    for cls in (0, 5, pitman_yor.START):
        total = 0.0
        for (s, _, _), w in zip(counts, words):
            unknown = np.array([12345678901 * (s + 1)], dtype=np.uint64) if s == 0 else np.zeros(0, dtype=np.uint64)
            asked = np.concatenate((w, unknown)) << np.uint64(pitman_yor.CLASS_BITS) | np.uint64(cls)
            own = blocks.filter(pa.compute.field("shard") == s).select(["shard", "block", "keys", "counts"])
            extra = pa.table({"shard": pa.array([s], own["shard"].type), "block": pa.array([-1], own["block"].type),
                              "keys": [asked.tobytes()], "counts": [np.zeros(len(asked), dtype=np.uint32).tobytes()]})
            t = pa.concat_tables([extra, own]).combine_chunks()
            answer = next(pitman_yor._answer_batches(iter(t.to_batches()), m))
            total += (10.0 ** np.frombuffer(answer.column("keys")[0].as_py(), dtype=np.float32)).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_language_model_edges(spark):
    out = language_model_scores(c.frame(spark, EDGE)).collect()
    assert len(out) == 5 and sorted(r.n_tokens for r in out) == [1, 1, 2, 2, 3]
    assert language_model_scores(c.frame(spark, [])).count() == 0
    i = next(i for i in range(100) if held(i, 7, 2))
    only = language_model_scores(c.frame(spark, [(i, "a b")])).collect()[0]  # nothing to learn from
    assert only.train_tokens == 0 and only.n_known == 0 and only.base_score == 0 and only.score == pytest.approx(0)


def test_language_model_tells_words_of_one_ending_apart(spark):
    """The context is the word before, not its ending: both first words end alike, only the order differs."""
    free = [i for i in range(400) if not held(i, 7, 2)]
    ask = [i for i in range(400) if held(i, 7, 2)][:2]
    rows = [(i, "basalt river" if k % 2 else "cobalt meadow") for k, i in enumerate(free)]
    rows += [(ask[0], "basalt river"), (ask[1], "basalt meadow")]
    score = {r.doc_id: r.score for r in language_model_scores(c.frame(spark, rows)).collect()}
    assert score[ask[0]] > score[ask[1]] + 1


def test_language_model_probabilities_sum_to_one_after_each_word(spark, docs):
    """Over all known types and the unknown one, after words of the corpus, a word never seen and a text's start."""
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.selectExpr("doc_id", "doc_id % 3 = 0 AS held_out", "text").mapInArrow(
        lambda it: pitman_yor._block_batches(it, shards), pitman_yor._SCHEMA)
    blocks = stored(found, "t").filter("shard >= 0").select("shard", "block", "keys", "counts", "contexts")
    counts = stored(blocks.repartition(shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(
        pitman_yor._count_batches, pitman_yor._COUNTS), "t")
    m = pitman_yor.fit(counts)
    known = m["contexts"][0].unionByName(m["contexts"][1]).toArrow()
    blocks = blocks.toArrow()
    keys = [np.frombuffer(r["keys"], dtype=np.uint64) for r in counts.orderBy("shard").collect()]
    seen = np.unique(np.concatenate([np.frombuffer(r["contexts"], dtype=np.uint64) for r in counts.collect()]))
    every = pa.chunked_array(known["contexts"]).to_pylist()
    asked_of = [set(np.frombuffer(b"".join(x for x, s in zip(every, known["shard"].to_pylist()) if s == k), np.uint64))
                for k in range(shards)]
    contexts = [x for x in seen.tolist() if all(x in a for a in asked_of)][:20]
    assert len(contexts) > 3
    for context in contexts:
        total = 0.0
        for s in range(shards):
            w = np.unique(keys[s] >> np.uint64(pitman_yor.CLASS_BITS)) << np.uint64(pitman_yor.CLASS_BITS)
            w = np.append(w, np.uint64(12345678912)) if s == 0 else w
            own = blocks.filter(pa.compute.equal(blocks["shard"], s))
            cls = next(int(k & np.uint64(31)) for t in blocks.to_pylist() for k, x in zip(
                np.frombuffer(t["keys"], np.uint64), np.frombuffer(t["contexts"], np.uint64)) if x == context)
            asked = w | np.uint64(cls)
            extra = pa.table({"shard": pa.array([s], own["shard"].type), "block": pa.array([0], own["block"].type),
                              "keys": [asked.tobytes()], "counts": [np.zeros(len(w), np.uint32).tobytes()],
                              "contexts": [np.full(len(w), context, np.uint64).tobytes()]})
            of = known.filter(pa.compute.equal(known["shard"], s))
            of = pa.table({"shard": of["shard"], "block": of["block"], "keys": of["keys"],
                           "counts": pa.nulls(len(of), pa.binary()), "contexts": of["contexts"]})
            t = pa.concat_tables([of, extra, own]).combine_chunks()
            answer = next(pitman_yor._answer_batches(iter(t.to_batches()), m))
            total += (10.0 ** np.frombuffer(answer.column("keys")[0].as_py(), dtype=np.float32)).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_steps_round_trip():
    size = np.array([3, 1, 2])
    index = np.array([0, 5, 200_000, 70_000, 65_535, 65_535])
    steps, n = pitman_yor._deltas(index, size)
    got, text = pitman_yor._indices(steps, n)
    assert got.tolist() == index.tolist() and text.tolist() == [0, 0, 0, 1, 2, 2]


def _op8_blocks(shards):
    texts = [t for _, t in ROWS] * 2 + [None, "", "b a b a the the"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([i % 3 == 0 for i in range(len(texts))]),
                                        pa.array(texts)], ["doc_id", "held_out", "text"])
    return batch, lambda: pitman_yor._block_batches(iter([batch]), shards)


def test_language_model_messages_come_back_from_records(spark, monkeypatch):
    """Packed messages, and those made again from records, have the same pairs in the same order, and all counts."""
    monkeypatch.setattr(pitman_yor, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(pitman_yor, "TaskContext", type("T", (), {"get": lambda: type("P", (), {"partitionId": lambda s: 1})()}))
    columns = ["shard", "block", "keys", "counts", "contexts"]
    _, made = _op8_blocks(5)
    plain = [b.select(columns) for b in made() if b.column(0)[0].as_py() >= 0]
    packed = [b for b in pitman_yor._packed_batches(made()) if b.column(0)[0].as_py() >= 0]
    assert pa.Table.from_batches(pitman_yor._plain_batches(packed)).to_pylist() == pa.Table.from_batches(plain).to_pylist()
    size = {k: sum(len(x) for b in some for c in cs for x in b[c].to_pylist())
            for k, some, cs in (("plain", plain, columns[2:]), ("packed", packed, [*columns[2:], "sizes"]))}
    assert len(plain) > 2 and size["packed"] < 0.9 * size["plain"]
    by_shard = pa.Table.from_batches(packed).sort_by([("shard", "ascending"), ("block", "ascending")]).to_batches()
    records = pa.Table.from_batches(pitman_yor._record_batches(iter(by_shard))).sort_by(
        [("shard", "ascending"), ("block", "ascending")])
    again = {(r["shard"], r["block"]): r for r in pa.Table.from_batches(
        pitman_yor._message_batches(iter(records.combine_chunks().to_batches()))).to_pylist()}
    want = pa.Table.from_batches(plain).to_pylist()
    assert len(again) == len(want) and {s for s, _ in again} == set(range(5))
    summed = {}
    for r in want:
        other = again[r["shard"], r["block"]]
        assert (other["keys"], other["contexts"]) == (r["keys"], r["contexts"])
        for sign, x in ((1, r), (-1, other)):
            for pair in zip(np.frombuffer(x["keys"], np.uint64).tolist(), np.frombuffer(x["contexts"], np.uint64).tolist(),
                            np.frombuffer(x["counts"], np.uint32).tolist()):
                summed[pair[:2]] = summed.get(pair[:2], 0) + sign * pair[2]
    assert summed and not any(summed.values())


def test_language_model_deals_one_shard_a_task(spark, docs, monkeypatch):
    """No task gathers several shards, the sums are rows of 32 classes, and messages and records are deleted when read."""
    made, seen = {}, {}

    def keep(df, name, *args, **options):
        if name in ("records", "totals"):
            seen.setdefault(name, []).append([r.asDict() for r in df.drop(*(
                c for c, kind in df.dtypes if kind == "binary")).withColumn("task", spark_partition_id()).collect()])
        made.setdefault(name, []).append(common.stored(df, name, *args, **options))
        return made[name][-1]

    def keep_by(*args, **options):
        made["blocks"] = list(common.stored_by(*args, **options).values())
        return dict(zip(args[3], made["blocks"]))

    monkeypatch.setattr(pitman_yor, "stored", keep)
    monkeypatch.setattr(pitman_yor, "stored_by", keep_by)
    assert language_model_scores(docs).count() == len(ROWS)
    for rows in seen["records"]:
        tasks = {}
        for r in rows:
            tasks.setdefault(r["task"], set()).add(r["shard"])
        assert all(len(x) == 1 for x in tasks.values())
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(sum(r["name"] is not None for r in rows) <= 30 * shards for rows in seen["totals"])
    gone = [*made["blocks"][1:], *made["records"], *made["totals"], *made["contexts"]]
    assert len(made["records"]) == pitman_yor.WAVES and not any(
        os.path.exists(x.scratch_path.removeprefix("file:")) for x in gone)


def test_toxicity_stems():
    raw = np.frombuffer("awfully awfulness x".encode(), dtype=np.uint8)
    features, counts = toxicity.word_features(raw, np.array([0, 7, 17, 19]))
    a, b, _ = np.split(features, np.cumsum(counts)[:-1])
    assert len(set(a) & set(b)) >= 2  # the shared stems
