"""Line dedup: an exact set-similarity join over all lines (built-in functions only).

A line's tokens are its 5-word shingles (a shorter line is one token, and similar only
to equal lines).  Two lines are
similar if the Jaccard similarity of their token sets is at least ``percent`` / 100;
a line with a similar line before it, in (doc_id, line number) order, is removed.

1. Lines are stored as text with single blanks between words.  Equal lines are one class (128 bits of
   hashes); all but the first line of a class go at once, so copies never meet in a join and their
   words are never cut.
2. Rarity: the words of all lines are counted in a fixed number of hash buckets.
   The counts make a small table (its size is a constant) that orders tokens, by the
   frequency of their last word and then by hash, the same way in every line: rarest
   first.
3. Prefix filter: lines of n tokens that are similar share a token among the first
   ``n - ceil(t * n) + 1``.  Tokens that occur in one line's prefix only are dropped
   after a count; for nearly all lines nothing is left.
4. What is left is joined on the token as a semi-join: a line asks whether some
   earlier line passes the length filter, the positional filter, a bitmap bound on the overlap
   and the exact Jaccard test.  It yields each line once at most, however large a group of alike
   lines is; pairs are never listed.  A first semi-join with the cheap filters
   picks the lines whose full token sets have to take part.

Joins of tables that grow with the input are shuffle joins at every size; generators are outer ones, as
Spark infers from others a filter that cuts the text a second time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import release, stored
from corvid.plans.joins import broadcast_if_small

SHINGLE = 5
# white space of any kind but the newline, and the scripts written without it (Thai to Khmer, kana, Han)
_SPACES = "\t\x0b\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_MAY_HAVE_SPACES = r"[\t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{3000}]"  # a quick test, true for more texts than need it
_UNSPACED = r"[\\x{E00}-\\x{EFF}\\x{1000}-\\x{109F}\\x{1780}-\\x{17FF}\\x{3040}-\\x{30FF}\\x{3400}-\\x{9FFF}\\x{20000}-\\x{323AF}]"
# a line without blanks in a script that has none is a sequence of characters
_WORDS = (f"CASE WHEN NOT contains(line, ' ') AND line RLIKE '{_UNSPACED}' THEN array_remove(split(line, ''), '') "
          "ELSE split(line, ' ') END")
_HASHES = f"transform({_WORDS}, x -> xxhash64(x))"
RARITY_BUCKETS = 4096
BITMAP_WORDS = 8  # 64-bit words of a line's bitmap
WAVES = 2  # parts of the prefix tokens that are shuffled one after another
MAX_SENT = 10_000  # rows of a broadcast; larger tables are shuffled, at every size of the input
_LINE = ["d", "line_no", "k1"]  # rows that repeat a doc_id may have different lines at a place
_LAST = 2 ** 63 - 1
_REST = "100000000"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines that are not blank, words parted by single blanks: ``d, line_no, k1, k2, line``."""
    d = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("d")
    text = F.col(text_col)
    text = F.when(text.rlike(_MAY_HAVE_SPACES), F.translate(text, _SPACES, " " * len(_SPACES))).otherwise(text)
    line = F.trim("line")
    lines = (docs.select(d, F.posexplode_outer(F.split(text, "\n")).alias("line_no", "line")).filter(line != "")
             .withColumn("line", F.when(F.contains("line", F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line)))
    return lines.select("d", "line_no", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(7), "line").alias("k2"), "line")


def _shingle_hashes(last: str = "xxhash64(a, y)") -> str:
    """SQL: one value per 5-word window of ``h``: hashes of words 1-2 and 3-4, of both, then with word 5.

    ``last`` combines the hash ``a`` of the first four words with the fifth word ``y``.
    """
    pairs = f"zip_with(h, slice(h, 2, {_REST}), (x, y) -> xxhash64(x, y))"
    fours = f"zip_with({{0}}, slice({{0}}, 3, {_REST}), (x, y) -> xxhash64(x, y))"
    # each step is computed once: transform over a one-element array binds it
    return (f"element_at(transform(array({pairs}), p -> element_at(transform(array({fours.format('p')}), "
            f"q -> slice(zip_with(q, slice(h, 5, {_REST}), (a, y) -> {last}), 1, greatest(size(h) - 4, 0))), 1)), 1)")


def _rarity(lines: DataFrame) -> str:
    """A constant array: for each bucket of words the rank (logarithm) of how often they occur in all lines."""
    counts = (lines.select(F.explode_outer(F.expr(_WORDS)).alias("x"))
              .groupBy(F.xxhash64("x").bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int").alias("bucket"))
              .agg(F.floor(F.log2(F.count(F.lit(1)).cast("double")) * 2).alias("rank")))
    rank = [0] * RARITY_BUCKETS
    for r in counts.collect():  # RARITY_BUCKETS rows at most
        rank[r["bucket"]] = int(r["rank"])
    return f"cast(split('{','.join(map(str, rank))}', ',') AS array<int>)"


def _tokens(rank: str) -> Column:
    """Distinct tokens of a line in ascending rarity order: rank of the last word in the top byte, hash below."""
    key = (f"shiftleft(cast(coalesce(get({rank}, cast(xxhash64(y) & {RARITY_BUCKETS - 1} AS int)), 0) AS bigint), 56) "
           f"| (xxhash64(a, y) & {2 ** 56 - 1}L)")
    # the words are cut once: transform over a one-element array binds them
    return F.expr(f"element_at(transform(array({_WORDS}), h -> sort_array(array_distinct({_shingle_hashes(key)}))), 1)")


def _need(n: Column, percent: int) -> Column:
    """ceil(percent / 100 * n) in whole numbers."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _earlier(y: str, x: str) -> Column:
    return (F.col(f"{y}.d") < F.col(f"{x}.d")) | (
        (F.col(f"{y}.d") == F.col(f"{x}.d")) & (F.col(f"{y}.line_no") < F.col(f"{x}.line_no")))


def _least(percent: int) -> Column:
    """The smallest overlap that reaches the similarity: ceil(percent * (nx + ny) / (100 + percent))."""
    return F.floor(((F.col("x.n") + F.col("y.n")) * percent + (100 + percent - 1)) / (100 + percent))


def _plausible(percent: int) -> Column:
    """Same token, length filter, positional filter (tokens up to the shared one, and after it), bitmaps."""
    nx, ny, i, j = F.col("x.n"), F.col("y.n"), F.col("x.i"), F.col("y.i")
    return ((F.col("x.token") == F.col("y.token")) & _earlier("y", "x")
            & (ny * 100 >= nx * percent) & (nx * 100 >= ny * percent)
            & (F.least(i, j) + F.least(nx - i, ny - j) >= _least(percent)) & _bitmaps_allow(percent))


def _set() -> Column:
    """The distinct 5-word shingles of a line, as hashes."""
    # the words are cut once: transform over a one-element array binds them
    return F.expr(f"element_at(transform(array({_HASHES}), h -> array_distinct({_shingle_hashes()})), 1)")


def _bitmaps(sets: DataFrame) -> DataFrame:
    """``b0..b7`` per line: a bit for each of its tokens."""
    x = sets.select(*_LINE, F.explode_outer("s").alias("x"))
    bit = F.expr("shiftleft(1L, cast(x & 63 AS int))")
    word = F.expr(f"cast(shiftrightunsigned(x, 6) & {BITMAP_WORDS - 1} AS int)")
    return x.groupBy(*_LINE).agg(*[F.bit_or(F.when(word == k, bit).otherwise(F.lit(0))).alias(f"b{k}")
                                   for k in range(BITMAP_WORDS)])


def _bitmaps_allow(percent: int) -> Column:
    """Every bit that only one line has is a token the other lacks: an upper bound of the overlap, never too low."""
    def only(a: str, b: str) -> Column:
        out = F.lit(0)
        for k in range(BITMAP_WORDS):
            out = out + F.bit_count(F.col(f"{a}.b{k}").bitwiseAND(F.bitwise_not(F.col(f"{b}.b{k}"))))
        return out
    return ((F.col("x.n") - only("x", "y") >= _least(percent))
            & (F.col("y.n") - only("y", "x") >= _least(percent)))


def _similar(asking: DataFrame, partners: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The lines of ``asking`` (postings) whose full set is similar to that of a partner with the same token."""
    asked = partners.join(asking.select("token").distinct(), "token", "left_semi")  # sets go with these tokens only
    x, y = asking.join(sets, _LINE).alias("x"), asked.join(sets, _LINE).alias("y")
    return x.join(y, _plausible(percent) & (F.size(F.array_intersect("x.s", "y.s")) >= _least(percent)),
                  "left_semi").select(*_LINE).distinct()


def _sent(df: DataFrame) -> DataFrame:
    """Broadcast if its checked size allows (a few longs a row), else as it is (a shuffle join)."""
    small = broadcast_if_small(df, max_rows=MAX_SENT)
    return small if small is not None else df


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """Lines that repeat an earlier one: ``doc_id, line_no`` (from 0) ``, reason`` (``exact`` or ``similar``).

    Lines are cut at newlines and words at white space of any kind; a line without any, in a script
    written without it, is taken character by character.  Every line that is not blank takes part; lines of
    up to ``SHINGLE`` words are similar to equal lines only.  Null and empty texts have no lines to remove.
    A line's place is (doc_id, line_no), null ids last; rows that repeat a doc_id are the same
    document and lose the same lines, and rows without an id are one document.  An empty table gives an
    empty result; other columns are not read.
    """
    lines = stored(_lines(docs, id_col, text_col), "lines", compression="zstd")
    place = (F.col("d").cast("decimal(20,0)") * F.lit(2 ** 31).cast("decimal(11,0)") + F.col("line_no")
             ).cast("decimal(38,0)")
    repeated = stored(lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
                      .filter("_n > 1"), "classes")
    marked = lines.join(_sent(repeated), ["k1", "k2"], "left")
    is_first = F.col("_first").isNull() | (F.col("_first") == place)
    exact = stored(marked.filter(~is_first).select("d", "line_no").distinct(), "exact")

    rank = _rarity(lines)
    # a line of one token is similar to equal lines only
    long_enough = (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) >= SHINGLE) | ~F.contains(
        "line", F.lit(" "))
    prefix = F.col("n") - _need(F.col("n"), percent) + 1
    firsts = stored(marked.filter(is_first & long_enough).select(*_LINE, _tokens(rank).alias("t"))
                    .select(*_LINE, F.size("t").alias("n"), F.slice("t", F.lit(1), prefix).alias("t")), "prefixes",
                    **{"parquet.enable.dictionary": "false"})
    release(repeated)
    of_token = Window.partitionBy("token")
    tokens = firsts.select(*_LINE, "n", F.posexplode_outer("t").alias("i", "token")).filter("token IS NOT NULL")
    # every token in one of the waves, so that the shuffle files of one part only are on disk at a time
    waves = [stored(tokens.filter(F.pmod("token", F.lit(WAVES)) == wave)
                    .withColumn("_shared", F.min("k1").over(of_token) < F.max("k1").over(of_token))
                    .filter("_shared").drop("_shared"), "postings", compression="zstd") for wave in range(WAVES)]
    postings = reduce(DataFrame.unionByName, waves)
    release(firsts)

    # from here on only lines that share a prefix token with another one
    touched = stored(lines.join(postings.select(*_LINE).distinct(), _LINE, "left_semi")
                     .select(*_LINE, _set().alias("s")), "touched", **{"parquet.enable.dictionary": "false"})
    release(lines)
    light = stored(postings.join(_bitmaps(touched), _LINE), "light", compression="zstd")
    for wave in waves:
        release(wave)
    x, y = light.alias("x"), light.alias("y")
    mine = stored(x.join(y, _plausible(percent), "left_semi"), "asking")

    # The exact test, for the tokens that found a plausible partner: only these lines' full sets take part.
    x, y = mine.alias("x"), light.join(mine.select("token").distinct(), "token", "left_semi").alias("y")
    partners = stored(y.join(x, _plausible(percent), "left_semi"), "partners")
    needed = mine.select(*_LINE).unionByName(partners.select(*_LINE)).distinct()
    sets = stored(touched.join(needed, _LINE, "left_semi"), "sets", **{"parquet.enable.dictionary": "false"})
    release(touched)
    # first on the lowest token of a line, then, for lines that found nothing, on all of them
    lowest = mine.join(mine.groupBy(*_LINE).agg(F.min("token").alias("_low")), _LINE).filter("token = _low").drop("_low")
    first = stored(_similar(lowest, partners, sets, percent), "first")
    rest = stored(_similar(mine.join(first, _LINE, "left_anti"), partners, sets, percent), "rest")
    for done in (light, mine, partners, sets):
        release(done)
    similar = first.unionByName(rest).select("d", "line_no").distinct()

    of_id = F.when(F.col("d") != _LAST, F.col("d")).alias("doc_id")
    return (exact.select(of_id, "line_no", F.lit("exact").alias("reason"))
            .unionByName(similar.select(of_id, "line_no", F.lit("similar").alias("reason"))))


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns, in order) with the lines listed in ``removed`` cut out of the text.

    A text all of whose lines are removed becomes empty; other texts, and texts without an
    id (``removed`` cannot tell them apart), stay as they are.
    """
    lists = removed.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("line_no").alias("_gone"))
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"),
                                 lambda x, i: ~F.array_contains("_gone", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)
    return (docs.join(lists, F.col(id_col).cast("long") == F.col("_doc"), "left")
            .select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns]))
