"""Tokenizing whole texts with public vocabularies; repeated words are encoded once per worker."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space other than the plain space; beside one of these a space does not start a piece by itself.
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
ROW = 200  # pieces encoded in one string
REMEMBERED = 900_000  # words, and pieces, that a worker keeps; when full, others are encoded again where they occur


def vocabulary(name: str) -> str:
    """Path of a public vocabulary; SWITCHFLOW_TOKENIZERS names another folder than the installed one."""
    folder = os.environ.get("SWITCHFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def plainly_spaced(text: str) -> bool:
    """Every space of the text stands alone between two visible characters, so that a byte-level
    pre-tokenizer starts a new piece at each and the parts in between encode independently."""
    if not text or "  " in text or text[0] == " " or text[-1] == " ":
        return False
    return not any(c in text and (c + " " in text or " " + c in text) for c in OTHER_SPACE)


def parted(text: str) -> str:
    """A plainly spaced text with a space before each line feed, where line feeds are its only other white
    space and stand alone: a piece starts and ends at each of them, so lines part words as spaces do."""
    if "\n" not in text or "\n\n" in text or any(c in text for c in OTHER_SPACE if c != "\n"):
        return text
    return text.replace("\n", " \n")


class Pieces:
    """Ids of texts, as bytes, put together from those of their parts; `encode` gets whole pieces, many at once."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], pattern: str, special: list[str] = ()):
        self.encode, self.find, self.special = encode, regex.compile(pattern).findall, special
        self.words: dict[str, bytes] = {}  # a word with its leading space, keyed without it
        self.pieces: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> list[str]:
        new = [p for p in pieces if p not in self.pieces]
        self.pieces.update(zip(new, self.encode(new), strict=True))
        return new

    def _learn_words(self, new: set[str]) -> tuple[list[str], list[str]]:
        """Letters alone, or with a mark behind them, need no pattern; returns what words and pieces were added."""
        plain = {w for w in new if w.isalpha()}
        marked = [w for w in new if w[-1:] in (".", ",") and w[:-1].isalpha()]
        plain.update(s for w in marked if (s := w[:-1]) not in self.words)
        added = list(plain)
        self.words.update(zip(added, self.encode([" " + w for w in added]), strict=True))
        found = {w: self.find(w if w[:1] == "\n" else " " + w) for w in new.difference(plain, marked)}
        pieces = self._learn({".", ",", *(p for f in found.values() for p in f)})
        for w in marked:
            self.words[w] = self.words[w[:-1]] + self.pieces[w[-1]]
        for w, f in found.items():
            self.words[w] = b"".join(map(self.pieces.__getitem__, f))
        return [*added, *marked, *found], pieces

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = self.encode([text])[0]  # a special token is found in the whole text only
            elif plainly_spaced(text):
                cut.append(i)
        whole = set(cut)
        rest = {i: self.find(text) for i, text in enumerate(texts) if out[i] is None and i not in whole}
        pieces = self._learn({p for f in rest.values() for p in f})
        for i, f in rest.items():
            out[i] = b"".join(map(self.pieces.__getitem__, f))
        if cut:
            for i, ids in zip(cut, self._cut([parted(texts[i]) for i in cut]), strict=True):
                out[i] = ids
        if len(self.pieces) > REMEMBERED:
            for x in pieces:
                self.pieces.pop(x, None)
        return out

    def _cut(self, texts: list[str]) -> list[bytes]:
        """The ids of plainly spaced texts: every different word is looked up once, and ids are gathered by number."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = lists.values.dictionary_encode()
        words, number = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        starts = lists.offsets.to_numpy()
        # The first word of a text has no space before it: it gets a number of its own.
        heads = [self.find(words[n]) for n in number[starts[:-1]].tolist()]
        number[starts[:-1]] = len(words) + np.arange(len(texts))
        added, pieces = self._learn_words({w for w in words if w not in self.words})
        pieces += self._learn({p for f in heads for p in f})
        known = [*map(self.words.__getitem__, words), *(b"".join(map(self.pieces.__getitem__, f)) for f in heads)]
        for memory, last in ((self.words, added), (self.pieces, pieces)):
            if len(memory) > REMEMBERED:
                for x in last:
                    memory.pop(x, None)
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = (np.cumsum(sizes) - sizes)[number]
        sizes = sizes[number]
        ends = np.cumsum(sizes)
        flat = ids[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1])]
        cuts = [0, *ends[starts[1:] - 1].tolist()]
        return [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def id_encoder(path: str) -> Pieces:
    """texts -> their ids as little-endian uint32 bytes, by the tokenizers library without added special tokens.

    A special token spelled out in a text is one id, as the library has it by default.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)

    def alone(pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(pieces, add_special_tokens=False)]

    def encode(pieces: list[str]) -> list[bytes]:
        # A space and letters is one piece wherever it stands, so such pieces are encoded in rows, and cut by their numbers.
        out: list = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p[:1] == " " and p[1:].isalpha()]
        rows = [plain[i : i + ROW] for i in range(0, len(plain), ROW)]
        for row, e in zip(rows, t.encode_batch(["".join([pieces[i] for i in r]) for r in rows], add_special_tokens=False), strict=True):
            ids, of = np.array(e.ids, dtype="<u4").tobytes(), np.array(e.word_ids)
            ends = [0, *(4 * np.flatnonzero(of[1:] != of[:-1]) + 4).tolist(), 4 * len(of)]
            if len(ends) == len(row) + 1:
                for i, a, b in zip(row, ends, ends[1:], strict=False):
                    out[i] = ids[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, alone([pieces[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    return Pieces(encode, PATTERN, [x.content for x in t.get_added_tokens_decoder().values()])


@lru_cache(maxsize=2)
def tiktoken_encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
