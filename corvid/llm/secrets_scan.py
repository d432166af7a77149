"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Patterns (fixed values of the contract, leftmost and non-overlapping per kind):
``assign`` a named credential with a value, ``access`` an access key id, ``hex`` a long
hexadecimal run.  A match that fails its length rule is dropped, but has used up its text.

Token efficiency: a byte-pair vocabulary packs natural language, code and identifiers
into few tokens; random strings cost about a token per one and a half characters.  A
run of ``[A-Za-z0-9+/=_-]`` of at least ``MIN_RUN`` characters, with letters and digits or with
a change from small to capital letters, is ``random`` if it has fewer than ``MAX_RATIO``
characters per token (``SHORT_RATIO`` for a run of under ``LONG_RUN``).  Known digests
(hexadecimal of a hash's length), UUIDs, plain numbers and identifiers (words, camel case,
numbers and short codes joined by marks) are excluded first, as are runs inside a pattern's span.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import ship_package

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # a maximal run of 16 or more, as ``[0-9a-f]+`` would find it
ASSIGN_MIN, ACCESS_MIN = 12, 18

MIN_RUN, LONG_RUN, SHORT_RATIO, MAX_RATIO = 16, 20, 1.9, 2.2
RUN = re.compile("[A-Za-z0-9+/=_-]{%d,}" % MIN_RUN)
DIGIT, LETTER, CASE_CHANGE = re.compile("[0-9]"), re.compile("[A-Za-z]"), re.compile("[a-z][A-Z]")
DIGEST = re.compile("(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}"
                    "|[0-9a-fA-F]{128})")
UUID = re.compile("[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# words, camel case, numbers and short codes joined by marks: order-2024-item-17, MAX_RETRY_3, src/getUserName/v2, AB12-CD34
_PART = ("(?:(?:[A-Z]{2,}|[A-Z]?[a-z]{2,})(?:[A-Z][a-z]{2,})*+|[A-Z]?[a-z]{2,11}[0-9]{1,4}|[A-Za-z]{1,4}[0-9]{1,4}"
         "|[0-9]+[A-Za-z]?|[0-9]+T[0-9]+|v[0-9]+)")
IDENTIFIER = re.compile(f"{_PART}(?:[+/=_-]+{_PART})*")

_vocabularies: dict[str, object] = {}


def _vocabulary(path: str, pattern: str):
    if path not in _vocabularies:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _vocabularies[path] = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _vocabularies[path]


def is_random(run: str, vocabulary) -> bool:
    """The token-efficiency test for one run."""
    if not (DIGIT.search(run) and LETTER.search(run) or CASE_CHANGE.search(run)):
        return False
    if DIGEST.fullmatch(run) or UUID.fullmatch(run) or IDENTIFIER.fullmatch(run):
        return False
    ratio = MAX_RATIO if len(run) >= LONG_RUN else SHORT_RATIO
    return len(run) < ratio * len(vocabulary.encode_ordinary(run))


def find_spans(text: str, vocabulary) -> list[tuple[int, int, int]]:
    """Spans ``(start, kind, end)`` of one text in code points, by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in ("pass", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    at, reach = 0, 0  # base spans that start before the run, and the furthest end among them
    for m in RUN.finditer(text):
        while at < len(base) and base[at][0] <= m.start():
            reach, at = max(reach, base[at][2]), at + 1
        if m.end() > reach and is_random(m.group(), vocabulary):
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    vocabulary = _vocabulary(path, pattern)
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            data = raw.tobytes()
            rows = [find_spans(data[off[i]:off[i + 1]].decode("utf-8", "replace"), vocabulary) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo),
                 *(pa.array([sum(k == kind for _, k, _ in r) for r in rows], type=pa.int64()) for kind in range(4)),
                 pa.array([_joined([x for x in r if x[1] < 3]) for r in rows], type=pa.string()),
                 pa.array([_joined(r) for r in rows], type=pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])


def scan_secrets(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Secrets in every whole text: ``doc_id, n_assign, n_access, n_hex, n_random, base, spans``.

    ``base`` and ``spans`` list ``kind:start:end`` (code points, end exclusive) of the pattern
    kinds and of all kinds, by start, then kind in the order of ``KINDS``.  ``vocabulary`` is
    the path of a rank file, ``pattern`` its splitting pattern.  Null and empty texts have no
    spans; repeated rows are scanned one by one; an empty table gives an empty result; other
    columns are not read.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(
        lambda it: _scan_batches(it, vocabulary, pattern),
        "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base string, spans string")
