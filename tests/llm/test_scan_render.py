"""Secret scans and HTML rendering beyond the plain cases: recall, false positives, depth, width, linear time."""

import random
import string
import time

import pytest
import public_tokenizers

from corvid.llm.html_render import render, render_pages
from corvid.llm.queries import tokenizer_path
from corvid.llm.secrets_scan import RUN, _vocabulary, find_spans, is_random, scan_secrets

BASE62 = string.ascii_letters + string.digits


@pytest.fixture(scope="module")
def vocabulary():
    return _vocabulary(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("alphabet,length,least", [(BASE62, 16, .85), (BASE62, 20, .95), (BASE62, 32, .97),
                                                   (string.ascii_letters, 22, .9), (string.ascii_letters, 32, .95)])
def test_random_strings_are_found(vocabulary, alphabet, length, least):
    r = random.Random(length)
    runs = ["".join(r.choice(alphabet) for _ in range(length)) for _ in range(500)]
    assert sum(is_random(x, vocabulary) for x in runs) >= least * len(runs)


def test_identifiers_are_not_random(vocabulary):
    for x in ("AB12-CD34-EF56-GH78-IJ90", "2024-01-01T00-00-00Z-backup-v2-final1", "getElementsByTagNameNS",
              "order-2024-item-17-final", "MAX_RETRY_COUNT_3", "d41d8cd98f00b204e9800998ecf8427e",
              "123e4567-e89b-12d3-a456-426614174000", "internationalization", "src/main/java/UserServiceImpl",
              "0123456789012345678901"):
        assert not is_random(x, vocabulary), x


def test_spans_against_brute_force(vocabulary):
    """Every run against every base span, one by one."""
    r = random.Random(3)
    words = ["token=abcdef0123456789", "AKIA" + "Q" * 18, "0123456789abcdef" * 2, "plain", "x7Kq9Zp2Lm4Rt8Vb",
             "secret: qWzXvBnMkLpOiUyTrEwQhG", "qWzXvBnMkLpOiUyTrEwQhG", "é", "api_key='Zx9/Kq2+Lm7=Vb4_'"]
    for _ in range(100):
        text = r.choice([" ", "\n", ";"]).join(r.choice(words) for _ in range(r.randint(0, 40)))
        spans = find_spans(text, vocabulary)
        base = [x for x in spans if x[1] < 3]
        want = [(m.start(), 3, m.end()) for m in RUN.finditer(text)
                if not any(s <= m.start() and m.end() <= e for s, _, e in base) and is_random(m.group(), vocabulary)]
        assert [x for x in spans if x[1] == 3] == want


def test_long_text_repeated_rows_and_empty_table(spark, vocabulary):
    text = "token=abcdef0123456789 x7Kq9Zp2Lm4Rt8Vb " * 20000
    began = time.time()
    assert len(find_spans(text, vocabulary)) == 60000 and time.time() - began < 20
    schema = "doc_id long, text string, spans string, base long"
    rows = [(1, text[:41], "x", 1), (1, text[:41], "x", 1), (None, None, None, None), (2, "", "", 2)]
    args = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = scan_secrets(spark.createDataFrame(rows, schema), *args).collect()
    assert sorted((r.doc_id or 0, r.n_assign, r.n_hex, r.n_random) for r in out) == [(0, 0, 0, 0), (1, 1, 1, 1), (1, 1, 1, 1),
                                                                                    (2, 0, 0, 0)]
    assert scan_secrets(spark.createDataFrame([], schema), *args).count() == 0


def test_visibility_and_tables_at_any_depth():
    deep = "<div>" * 5000
    out = render(deep + "a<p hidden>SECRET</p><span style='display:none'>S2</span>b")
    assert out == "ab"
    assert render(deep + "<table><tr><td>a<td>b<tr><td>cc<td>d</table>") == "a  | b\ncc | d"
    assert render("<ul><li>" * 3000 + "x" + "</ul>" * 3000 + "y").split() == ["-"] * 512 + ["x", "y"]


def test_wide_columns_visibility_and_numbers():
    wide = "w" * 90
    assert render(f"<table><tr><td>{wide}<td>b<tr><td>c<td>d</table>") == f"{wide} | b\n{'c'.ljust(90)} | d"
    assert render("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>") == "yes"
    assert render("<ol start=-3><li>a<li>b<li value=5>c<li>d</ol>") == "-3. a\n-2. b\n5. c\n6. d"


def test_hostile_pages_take_linear_time(spark):
    for piece in ("<a b=\"'", "<a b=\"'>", "</x", "<!", "<li><p>", "<td>", "<table><td>x", "<a 'b\">t"):
        began = time.time()
        render(piece * (300_000 // len(piece)))
        assert time.time() - began < 20, piece
    assert render("a < b <c d=\"e f") == "a < b <c d=\"e f"
    rows = [(1, "<p>" + "word " * 200_000, "x"), (1, "", "x"), (None, None, "x")]
    out = render_pages(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert sorted(len(r.text) for r in out) == [0, 0, 999_999]
