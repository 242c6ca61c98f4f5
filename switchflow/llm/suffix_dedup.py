"""Removal of byte strings that an earlier document holds, decided by sorting suffixes.

Three steps, each bounded per task however common a string is:

1. Winnowing: of the k-grams inside every `length`-byte window the one of least hash is the
   window's anchor, so equal windows have equal anchors at equal places. Anchors seen in
   one document only can't be part of a repeat. A task first joins what its own documents
   share and then sends each anchor once.
2. The bytes around repeated anchors (exactly the windows that belong to the anchor) are
   brought together by anchor, equal ones of a task as one.
   Of documents with one text only the smallest takes part; the others lose it whole.
3. Where the surroundings of an anchor differ, the suffixes that start in them are sorted
   to `length` bytes: multikey quicksort in characters of eight bytes to a shallow depth,
   then blind tries for groups that still share their prefix. Suffixes with `length` bytes
   in common are one string; its smallest document keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import partitions, whole_text
from switchflow.session import materialize

LENGTH = 50
GRAM = 16
SHALLOW = 3  # characters of eight bytes that the quicksort looks at
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 60_000
PIECE = 1 << 20  # windows of a text that are winnowed at once
SORTED = 1 << 19  # suffixes after which a sort takes no further anchor
BUCKETS = 4  # per shuffle partition
_DRAW = np.random.default_rng(7)
BYTE = _DRAW.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
PLACE = np.uint64(PIECE * 2 - 1)


# --- anchors --------------------------------------------------------------------


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    h, power = BYTE[x], BASE
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, window after the last, place of the anchor, key) of each run of windows with one anchor.

    key // 2**32 is a bucket below `buckets`.
    """
    n = len(text) - LENGTH + 1
    out = []
    for at in range(0, max(n, 0), PIECE):
        here = min(PIECE, n - at)
        h = _gram_hashes(np.frombuffer(text, np.uint8, here + LENGTH - 1, at))
        # The place breaks ties to the left, and tells where the least hash is.
        m = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        width, span = 1, LENGTH - GRAM + 1
        while width * 2 <= span:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if span > width:
            m = np.minimum(m[: width - span], m[span - width :])
        place = (m & PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        place = place[first]
        z = h[place] * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(32)
        key = ((z % np.uint64(buckets)) << np.uint64(32)) | (z >> np.uint64(32))
        out.append((at + first, at + np.append(first[1:], here), at + place, key))
    if not out:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


# --- suffix sorting ---------------------------------------------------------------


class BlindTrie:
    """Strings of one length, ordered by a trie that keeps only the places where they branch."""

    def __init__(self):
        self.root = None  # a leaf is a list [text, members]; a node is (depth, {byte: child})

    def add(self, text: bytes, members: list[int]) -> None:
        if self.root is None:
            self.root = [text, members]
            return
        # Blind search: follow the branching bytes alone, then compare with one whole string.
        node = self.root
        while isinstance(node, tuple):
            branches = node[1]
            node = branches.get(text[node[0]]) or next(iter(branches.values()))
        other = node[0]
        if other == text:
            node[1].extend(members)
            return
        depth = next(i for i, (a, b) in enumerate(zip(other, text, strict=True)) if a != b)
        parent, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
        leaf = [text, members]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][text[depth]] = leaf
            return
        new = (depth, {other[depth]: node, text[depth]: leaf})
        if parent is None:
            self.root = new
        else:
            parent[1][text[parent[0]]] = new

    def leaves(self) -> Iterator[list[int]]:
        """Members of equal strings, strings in order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            elif node:
                yield node[1]


def _characters(data: np.ndarray) -> np.ndarray:
    """At each byte the eight bytes from there, as one number that orders like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(data)
    out = padded[:n].copy()
    for i in range(1, 8):
        out = (out << np.uint64(8)) | padded[i : i + n]
    return out


def sort_suffixes(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): starts[order] are ascending by their `length` bytes; equal strings have one group number.

    length must be at least 8 * shallow, and data hold `length` bytes from every start.
    """
    chars = _characters(data)
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    for depth in range(shallow):
        # Only tied suffixes are looked at; each round splits every tied group by its next character.
        size = np.bincount(group, minlength=1)[group]
        tied = np.flatnonzero(size > 1)
        if not len(tied):
            break
        c = chars[starts[order[tied]] + 8 * depth]
        by = np.lexsort((c, group[tied]))
        order[tied], c = order[tied[by]], c[by]
        g = group[tied]
        new = np.zeros(len(group), bool)
        new[tied[1:]] = (c[1:] != c[:-1]) & (g[1:] == g[:-1])
        new[1:] |= group[1:] != group[:-1]
        group = np.cumsum(new)
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)) if len(group) else np.empty(0, np.int64)
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    tail_at = starts + 8 * shallow
    tail = length - 8 * shallow
    words = [np.minimum(8 * i, tail - 8) for i in range(-(-tail // 8))] if tail >= 8 else None
    deep = ends - begins > 1
    if words is not None and deep.any():
        # A group whose strings are all equal is a trie of one leaf.
        same = np.ones(len(ends), bool)
        for w in words:
            c = chars[tail_at[order] + w]
            same &= np.minimum.reduceat(c, begins) == np.maximum.reduceat(c, begins)
        deep &= ~same
    new = np.zeros(len(group), bool)
    new[begins[1:]] = True
    if words is not None and deep.any():
        # A trie of two leaves has one branch: where the strings first differ. All such tries at once.
        two = np.flatnonzero(deep & (ends - begins == 2))
        a, b = order[begins[two]], order[begins[two] + 1]
        swap = np.zeros(len(two), bool)
        open_ = np.ones(len(two), bool)
        for w in words:
            x, y = chars[tail_at[a] + w], chars[tail_at[b] + w]
            swap |= open_ & (x > y)
            open_ &= x == y
        order[begins[two]], order[begins[two] + 1] = np.where(swap, b, a), np.where(swap, a, b)
        new[begins[two] + 1] = True
        deep[two] = False
    raw = data.tobytes() if deep.any() else b""
    for b, e in zip(begins[deep].tolist(), ends[deep].tolist(), strict=True):
        members = order[b:e]
        trie, strings = BlindTrie(), {}
        for m, at in zip(members.tolist(), tail_at[members].tolist(), strict=True):
            strings.setdefault(raw[at : at + tail], []).append(m)
        for text, own in strings.items():
            trie.add(text, own)
        at = b
        for leaf in trie.leaves():
            new[at] = True
            order[at : at + len(leaf)] = leaf
            at += len(leaf)
    if len(new):
        new[0] = False
    return order, np.cumsum(new)


# --- steps ------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list[tuple]]]:
    """(number, rows) of bounded parts of a task's rows; the last column is the text."""
    base, seq, rows, size = TaskContext.get().partitionId() << 32, 0, [], 0
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(columns)], strict=True):
            rows.append(row)
            size += len(row[-1])
            if size >= CHUNK_BYTES or len(rows) >= CHUNK_DOCS:
                yield base + seq, rows
                seq, rows, size = seq + 1, [], 0
    if rows:
        yield base + seq, rows


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), part


def _repeated(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, keys): for each document the keys of its anchors that another document has too."""
    packed = "bucket long, chunk long, sure binary, doc binary, short binary"

    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _chunks(batches, 2):
            found = [np.unique(anchors(text, buckets)[3]) for _, text in rows]
            ids = np.array([r[0] for r in rows], "<i8")
            key = np.concatenate(found)
            doc = np.repeat(np.arange(len(rows), dtype="<u2"), [len(f) for f in found])
            out = [(-1 - chunk, chunk, b"", ids.tobytes(), b"")]
            if len(key):
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                begins = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
                low, high = np.minimum.reduceat(ids[doc], begins), np.maximum.reduceat(ids[doc], begins)
                sure = np.repeat(low != high, np.diff(np.append(begins, len(key))))
                # What the chunk's own documents share is known; one of them asks for the key, all of them are told here.
                known = np.flatnonzero(sure)
                out.append((-1 - chunk, chunk, b"", doc[known].tobytes(), key[known].astype("<u8").tobytes()))
                ask = np.union1d(begins, np.flatnonzero(~sure))
                for b, part in _by_bucket((key[ask] >> np.uint64(32)).astype(np.int64)):
                    at = ask[part]
                    short = (key[at] & np.uint64(0xFFFFFFFF)).astype("<u4")
                    out.append((b, chunk, sure[at].astype(np.uint8).tobytes(), doc[at].tobytes(), short.tobytes()))
            yield _batch(out, [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], packed)

    def answer(t: pa.Table) -> pa.Table:
        bucket, chunks, sures, docs_, shorts = (t.column(i).to_pylist() for i in range(5))
        if bucket[0] < 0:  # a chunk's own rows pass
            return t.drop_columns(["bucket", "sure"])
        short = np.concatenate([np.frombuffer(s, "<u4") for s in shorts])
        doc = np.concatenate([np.frombuffer(d, "<u2") for d in docs_])
        sure = np.concatenate([np.frombuffer(s, np.uint8) for s in sures]).astype(bool)
        row = np.repeat(np.arange(len(chunks)), [len(s) // 4 for s in shorts])
        order = np.argsort(short, kind="stable")
        s = short[order]
        begins = np.concatenate(([0], np.flatnonzero(s[1:] != s[:-1]) + 1))
        n = np.diff(np.append(begins, len(s)))
        known = np.logical_or.reduceat(sure[order], begins) | (n > 1)
        hit = order[np.repeat(known, n)]
        hit = hit[~sure[hit]]
        out = []
        for r, part in _by_bucket(row[hit]):
            at = hit[part]
            keys = (np.uint64(bucket[0]) << np.uint64(32)) | short[at].astype(np.uint64)
            out.append((chunks[r], doc[at].tobytes(), keys.astype("<u8").tobytes()))
        return pa.Table.from_batches([_batch(out, [pa.int64(), pa.binary(), pa.binary()], "chunk long, doc binary, short binary")])

    def told(t: pa.Table) -> pa.Table:
        ids, docs_, keys = None, [], []
        for _, d, k in zip(*[t.column(i).to_pylist() for i in range(3)], strict=True):
            if d and not k:
                ids = np.frombuffer(d, "<i8")
            elif k:
                docs_.append(np.frombuffer(d, "<u2"))
                keys.append(np.frombuffer(k, "<u8"))
        out = []
        if keys:
            doc, key = np.concatenate(docs_), np.concatenate(keys)
            out = [(int(ids[d]), _pack(np.sort(key[part]).tobytes())) for d, part in _by_bucket(doc.astype(np.int64))]
        return pa.Table.from_batches([_batch(out, [pa.int64(), pa.binary()], "doc_id long, keys binary")])

    asked = docs.select("doc_id", "b").mapInArrow(request, packed)
    answered = asked.groupBy("bucket").applyInArrow(answer, "chunk long, doc binary, short binary")
    return answered.groupBy("chunk").applyInArrow(told, "doc_id long, keys binary")


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _packed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, th, b) with b compressed, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for x in batches:
            yield pa.RecordBatch.from_arrays([*x.columns[:2], pa.array([pack(t) for t in x.column(2).to_pylist()], pa.binary())], names=["doc_id", "th", "b"])

    return docs.select("doc_id", "th", "b").mapInArrow(run, "doc_id long, th long, b binary")


def _copies(docs: DataFrame) -> DataFrame:
    """(doc_id, th): rows whose whole text a smaller document has."""
    named = docs.select("doc_id", "th", F.md5("b").alias("text"))
    least = materialize(named.groupBy("text").agg(F.min("doc_id").alias("least")), "equal-texts")
    return named.join(least, "text").filter("doc_id > least").select("doc_id", "th").distinct()


def _batch(rows: list[tuple], types: list, schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _removed(docs: DataFrame, repeated: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, th, spans): spans are pairs of 64-bit numbers, the window starts that are repeats, [first, last].

    repeated: (doc_id, keys, copies), copies the hashes of texts that are dealt with already.
    """
    packed = "bucket long, chunk long, head binary, body binary"

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            new = [th not in (skip or ()) for th, skip in zip(x.column(1).to_pylist(), x.column(3).to_pylist(), strict=True)]
            x = x.filter(pa.array(new, pa.bool_()))
            keys = [b"".join(map(_unpack, v)) for v in x.column(2).to_pylist()]
            text = [_unpack(v) for v in x.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*x.columns[:2], *[pa.array(t, pa.binary()) for t in (keys, text)]], names=["doc_id", "th", "keys", "b"])

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _chunks(unpacked(batches), 4):
            # The same surroundings in several documents of the chunk: the smallest one stands for them.
            seen: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
            for i, (_, _, keys, text) in enumerate(rows):
                lo, hi, place, key = anchors(text, buckets)
                at = np.isin(key, np.frombuffer(keys, "<u8"))
                for a, b, p, k in zip(lo[at].tolist(), hi[at].tolist(), place[at].tolist(), key[at].tolist(), strict=True):
                    seen.setdefault((k, p - a, text[a : b + LENGTH - 1]), []).append((i, a))
            sent: dict[int, list[tuple[int, int, int, bytes, int]]] = {}
            spans: list[tuple[int, int, int]] = []
            for (k, offset, body), where in seen.items():
                least = min(rows[i][0] for i, _ in where)
                for i, a in where:
                    if rows[i][0] > least:
                        spans.append((i, a, a + len(body) - LENGTH))
                    else:
                        sent.setdefault(k >> 32, []).append((k & 0xFFFFFFFF, offset, i, body, a))
            own = np.array([(r[0], r[1]) for r in rows], "<i8")
            out = [(-1 - chunk, chunk, b"ids", own.tobytes()), (-1 - chunk, chunk, b"spans", _spans(spans))]
            for b, entries in sent.items():
                head = Head.write([(k, offset, rows[i][0], i, a, len(body)) for k, offset, i, body, a in entries])
                out.append((b, chunk, head, _pack(b"".join(e[3] for e in entries))))
            yield _batch(out, [pa.int64(), pa.int64(), pa.binary(), pa.binary()], packed)

    def decide(t: pa.Table) -> pa.Table:
        bucket, chunks, heads, bodies = (t.column(i).to_pylist() for i in range(4))
        if bucket[0] < 0:
            return t.drop_columns(["bucket"])
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for chunk, i, a, b in repeats(chunks, [Head.read(h) for h in heads], [_unpack(b) for b in bodies]):
            spans.setdefault(chunk, []).append((i, a, b))
        out = [(c, b"spans", _spans(s)) for c, s in spans.items()]
        return pa.Table.from_batches([_batch(out, [pa.int64(), pa.binary(), pa.binary()], "chunk long, head binary, body binary")])

    def told(t: pa.Table) -> pa.Table:
        own, spans = None, []
        for _, head, body in zip(*[t.column(i).to_pylist() for i in range(3)], strict=True):
            if head == b"ids":
                own = np.frombuffer(body, "<i8").reshape(-1, 2)
            else:
                spans.append(np.frombuffer(_unpack(body), "<u4").reshape(3, -1).T.astype("<i8"))
        every = np.concatenate(spans)
        out = [(int(own[i, 0]), int(own[i, 1]), _pack(merged(every[part, 1:]).tobytes())) for i, part in _by_bucket(every[:, 0])]
        return pa.Table.from_batches([_batch(out, [pa.int64(), pa.int64(), pa.binary()], "doc_id long, th long, spans binary")])

    texts = _packed(docs)
    keys = repeated.withColumnRenamed("doc_id", "id2")
    joined = texts.join(keys, texts["doc_id"] == keys["id2"]).select("doc_id", "th", "keys", "copies", "b")
    around = joined.mapInArrow(surround, packed)
    decided = around.groupBy("bucket").applyInArrow(decide, "chunk long, head binary, body binary")
    return decided.groupBy("chunk").applyInArrow(told, "doc_id long, th long, spans binary")


class Head:
    """What is sent with surroundings: key, place of the anchor, document, its number in the chunk, start, size."""

    KINDS = ("<u4", "<u1", "<i8", "<u2", "<u4", "<u1")

    @classmethod
    def write(cls, rows: list[tuple]) -> bytes:
        return _pack(b"".join(np.array(c, kind).tobytes() for c, kind in zip(zip(*rows, strict=True), cls.KINDS, strict=True)))

    @classmethod
    def read(cls, data: bytes) -> list[tuple]:
        data, out, at = _unpack(data), [], 0
        n = len(data) // sum(np.dtype(k).itemsize for k in cls.KINDS)
        for kind in cls.KINDS:
            out.append(np.frombuffer(data, kind, n, at).tolist())
            at += n * np.dtype(kind).itemsize
        return list(zip(*out, strict=True))


def _spans(rows: list[tuple[int, int, int]]) -> bytes:
    return _pack(np.array(rows, "<u4").reshape(-1, 3).T.tobytes())


def merged(pairs: np.ndarray) -> np.ndarray:
    """[first, last] window starts put together where their bytes touch; as many windows, fewer pairs."""
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > ends[:-1] + LENGTH)))
    return np.stack([pairs[new, 0], np.append(ends[new[1:] - 1], ends[-1])], axis=1)


def repeats(chunks: list[int], heads: list[list[tuple]], bodies: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(chunk, document, first, last): runs of window starts that a smaller document has too, among the surroundings of a bucket."""
    by_key: dict[int, dict[bytes, list[tuple]]] = {}
    for chunk, head, body in zip(chunks, heads, bodies, strict=True):
        at = 0
        for k, offset, doc, i, a, n in head:
            # The place of the anchor goes first, as equal bytes with other anchors are other surroundings.
            by_key.setdefault(k, {}).setdefault(bytes((offset,)) + body[at : at + n], []).append((doc, chunk, i, a))
            at += n
    batch, n = [], 0
    for own in by_key.values():
        classes = []
        for body, entries in own.items():
            least = min(e[0] for e in entries)
            for doc, chunk, i, a in entries:
                if doc > least:
                    yield chunk, i, a, a + len(body) - 1 - LENGTH
            classes.append((body[1:], [e for e in entries if e[0] == least]))
        if len(classes) > 1:
            batch += classes
            n += sum(len(body) - LENGTH + 1 for body, _ in classes)
        if n > SORTED:
            yield from _in_sorted(batch)
            batch, n = [], 0
    if batch:
        yield from _in_sorted(batch)


def _in_sorted(differ: list[tuple[bytes, list[tuple]]]) -> Iterator[tuple[int, int, int, int]]:
    """The same for surroundings that differ, each with the entries of its smallest document, by sorting their suffixes."""
    sizes = np.array([len(body) for body, _ in differ])
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    data = np.frombuffer(b"".join(body for body, _ in differ), np.uint8)
    n = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(differ)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = begin[of] + step
    least = np.array([entries[0][0] for _, entries in differ])
    order, group = sort_suffixes(data, starts)
    owner = least[of[order]]
    first = np.minimum.reduceat(owner, np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1)))
    gone = np.zeros(len(starts), bool)
    gone[order[owner > first[group]]] = True
    # Runs of removed windows inside each surrounding.
    edge = np.flatnonzero(gone & np.concatenate(([True], ~gone[:-1] | (of[1:] != of[:-1]))))
    stop = np.flatnonzero(gone & np.concatenate((~gone[1:] | (of[1:] != of[:-1]), [True])))
    for a, b in zip(edge.tolist(), stop.tolist(), strict=True):
        for _, chunk, i, at in differ[of[a]][1]:
            yield chunk, i, at + int(step[a]), at + int(step[b])


def kept_bytes(text: bytes, spans: list[bytes], copy: bool = False) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal runs removed) for window starts to remove; a copy goes whole."""
    if copy:
        return b"", len(text), 1
    if not spans:
        return text, 0, 0
    pairs = merged(np.concatenate([np.frombuffer(s, "<i8").reshape(-1, 2) for s in spans]))
    out, at = [], 0
    for a, b in pairs.tolist():
        out.append(text[at:a])
        at = b + LENGTH
    out.append(text[at:])
    return b"".join(out), int((pairs[:, 1] - pairs[:, 0] + LENGTH).sum()), len(pairs)


def remove_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans): one row for each row of docs, kept the bytes that stay.

    A byte goes if a string of 50 bytes over it also starts in a document with a smaller
    doc_id; strings are judged on the input. doc_id is an integer. Rows with a null
    doc_id are before and after no document: they stay whole and remove nothing. Rows
    with equal ids don't remove from each other. Null and empty texts have no bytes.
    What is left need not be valid UTF-8. Other columns are not read; an empty table
    gives an empty result.
    """
    buckets = BUCKETS * partitions(docs.sparkSession)
    text = whole_text(text_column).cast("binary")
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("b"))
    long = lean.filter(F.col("doc_id").isNotNull() & (F.length("b") >= LENGTH))
    copies = materialize(_copies(long), "equal-documents")
    repeated = materialize(_repeated(long, buckets), "repeated-anchors").groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    skipped = copies.groupBy("doc_id").agg(F.collect_set("th").alias("copies"))
    keys = repeated.join(skipped, "doc_id", "left").select("doc_id", "keys", "copies")
    spans = materialize(_removed(long, keys, buckets), "removed-spans")
    # Equal rows in different tasks each told their spans.
    gone = spans.withColumn("copy", F.lit(False)).unionByName(copies.select("doc_id", "th", F.lit(None).cast("binary").alias("spans"), F.lit(True).alias("copy")))
    gone = gone.groupBy(F.col("doc_id").alias("id2"), F.col("th").alias("th2")).agg(F.collect_list("spans").alias("spans"), F.max("copy").alias("copy"))
    texts = _packed(lean)
    joined = texts.join(gone, (F.col("doc_id") == F.col("id2")) & (F.col("th") == F.col("th2")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows, sizes = [], []
            for z, packed, copy in zip(*[x.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                data = _unpack(z)
                sizes.append(len(data))
                rows.append(kept_bytes(data, [_unpack(p) for p in packed or ()], bool(copy)))
            cols = [x.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array(sizes, pa.int64()), *[pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.select("doc_id", "b", "spans", "copy").mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
