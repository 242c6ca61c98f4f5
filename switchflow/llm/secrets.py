"""Secret scan: fixed patterns, and strings that a tokenizer's vocabulary compresses badly.

Natural words and identifiers are made of long vocabulary entries, random strings of
short ones: few characters per token give a random string away.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import whole_text
from switchflow.llm.tokens import tiktoken_encoding, vocabulary

KINDS = ("assign", "access", "hex", "random")
# Case is ignored for A-Z alone, so the letters are spelled out by the ASCII flag.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 12
NAMES = ("password", "passwd", "secret", "token", "api")
# Runs are maximal, so a least length in the pattern drops the same matches as a test afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}  # MD5 to SHA-512
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
NUMBER = re.compile(r"[0-9+/_=-]+")
RATIO = 2.2  # characters per token below which a candidate counts as random


def known(text: str) -> bool:
    """Digests, UUIDs and numbers: written down in the open."""
    if NUMBER.fullmatch(text) or UUID.fullmatch(text):
        return True
    return len(text) in DIGEST_LENGTHS and bool(DIGEST.fullmatch(text))


def named(text: str, encode) -> bool:
    """Names of things: snake or camel parts, each a word of the vocabulary in lower case, four letters long on average."""
    parts = PART.findall(text)
    if not parts or sum(map(len, parts)) < max(4 * len(parts), 0.75 * len(text)):
        return False
    return all(len(encode(p.lower())) == 1 or len(encode(" " + p.lower())) == 1 for p in parts)


def find(text: str, encode, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """(start, position in KINDS, end) of all spans, sorted; code points, end exclusive.

    A span covers the whole match. Of each kind spans are leftmost and do not overlap.
    """
    spans = []
    low = text.lower()
    if any(n in low for n in NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if not known(s) and len(s) < ratio * len(encode(s)) and not named(s, encode):
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, tokens: str | None = None, ratio: float = RATIO, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base, spans): one row for each row of docs, without a shuffle.

    base holds the spans of the fixed patterns, spans those and the random strings, both
    as kind:start:end joined by commas. Null and empty texts have none; ids may repeat
    or be null; other columns of docs are not read.
    """
    path = tokens or vocabulary("byte_bpe_50k.tiktoken")
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken_encoding(path).encode_ordinary
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in b.column(1):
                spans = find(text.as_py(), encode, ratio)
                for k in range(4):
                    cols[k].append(sum(s[1] == k for s in spans))
                cols[4].append(joined([s for s in spans if s[1] < 3]))
                cols[5].append(joined(spans))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=names)

    names = ["id", "n_assign", "n_access", "n_hex", "n_random", "base", "spans"]
    lean = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    found = lean.mapInArrow(run, f"id {id_type}, n_assign long, n_access long, n_hex long, n_random long, base string, spans string")
    return found.withColumnRenamed("id", id_column)


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """The text with every span of `scan` replaced, overlapping ones by one mark."""
    out, at = [], 0
    for _, a, b in sorted((x.split(":") for x in spans.split(",") if x), key=lambda x: int(x[1])):
        if int(a) >= at:
            out += [text[at : int(a)], mark]
        at = max(at, int(b))
    return "".join([*out, text[at:]])

