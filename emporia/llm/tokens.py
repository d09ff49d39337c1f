"""Token ids of whole texts, from a vocabulary file of the tokenizers library.

A byte-level BPE encodes each pre-tokenized word on its own, and a word never
reaches over a place where a single space stands between two characters that
aren't white space.  Texts are cut there, a batch at a time in Arrow; each
distinct piece of a batch is looked up once in a bounded table (a new one goes
through the library's model), and the batch's ids are gathered in numpy.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces a worker keeps; the table is emptied when it is full.
KEPT_PIECES = 700_000
#: Longer pieces are encoded each time.
KEPT_LENGTH = 64

_CUT = re.compile(r"(?<=\S)(?= \S)")
#: White space beside a space: only then does splitting at spaces differ from cutting.
_ODD = re.compile(r" \s|[^\S ] ")
#: A text that can't be split at its spaces: white space (as Python knows it) beside a space or at an end.
_SPACES = r"\x09-\x0d\x1c-\x1f\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNSPLIT = f" [{_SPACES}]|[{_SPACES}] |^ | $"
#: A line break between two visible characters is a piece of its own.
_LINES = re.compile(r"(.*\S)\n(\S.*)", re.DOTALL)
_HEAD = re.compile(r"( ?[^\W\d_]+)(.+)", re.DOTALL)


def _byte_letters() -> dict[int, int]:
    """Byte to the character that stands for it in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes; itself the table of pieces."""

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One encoder per vocabulary and worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text, cut before single spaces between two visible characters."""
        if _ODD.search(text) or text[:1] == " " or text[-1:] == " ":
            return _CUT.split(text)
        words = text.split(" ")
        return [words[0]] + [" " + w for w in words[1:]]

    def __missing__(self, piece: str) -> bytes:
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalpha():  # a pre-tokenized word: straight through the library's model
            tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        else:
            # a run of letters ends a word wherever another character follows it
            parts = _HEAD.match(piece)
            lines = _LINES.fullmatch(piece) if "\n" in piece else None
            if parts and parts[1].lstrip(" ").isalpha():
                ids = self[parts[1]] + self[parts[2]]
            elif lines:
                ids = self[lines[1]] + self["\n"] + self[lines[2]]
            else:
                found = self.tokenizer.encode(piece, add_special_tokens=False)
                ids = np.array(found.ids, "<u4").tobytes()
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        edges, ids = self.encode_array(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data = memoryview(ids.astype("<u4", copy=False)).cast("B")
        edges = (4 * edges).tolist()
        return [bytes(data[lo:hi]) for lo, hi in zip(edges, edges[1:])]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch of texts (no nulls): where each text's begin, one more at the end, and all ids."""
        plain = pc.invert(pc.match_substring_regex(texts, _UNSPLIT))
        split = pc.split_pattern(pc.if_else(plain, texts, ""), " ")
        edges = split.offsets.to_numpy().astype(np.int64)
        edges, words = edges - edges[0], split.flatten()
        # by distinct word: what is cut at a space; by text: the word it begins with, or all of one that can't be split
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.__getitem__, map(" ".__add__, distinct)))
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = which[edges[:-1]].tolist()
        for i, (code, whole) in enumerate(zip(heads, plain.to_pylist())):
            found.append(self[distinct[code]] if whole else b"".join(map(self.__getitem__, self.pieces(texts[i].as_py()))))
        which[edges[:-1]] = len(distinct) + np.arange(len(heads))
        table = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        size = lengths[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = table[np.repeat(starts[which] - (ends - size), size) + np.arange(total)]
        return np.r_[0, ends[edges[1:] - 1]].astype(np.int64) if len(heads) else np.zeros(1, np.int64), ids
