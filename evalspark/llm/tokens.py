"""Ids of whole texts by a public word-level tokenizer, one word at a time."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from evalspark.llm.common import Remembered, kept

#: These letters have one form and the same lower case everywhere.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: ASCII marks of which any run is one piece. An apostrophe may begin a piece with letters,
#: "<" may begin one of the tokenizer's own marks.
MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: Letters with or without end marks: two pieces for the tokenizer.
PLAIN = f"^[{LETTERS}]+[{re.escape(MARKS)}]*$"
LEADING = f"^[{LETTERS}]+"
END_ID = 1
#: Bytes of texts whose words are looked at together.
CHUNK = 4 << 20


def _shown_bytes() -> list[str]:
    """Characters that byte-level vocabularies write bytes as.

    Printable bytes of Latin-1 stand for themselves, the others follow from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


_SHOWN = _shown_bytes()


def _listed(values: pa.Array) -> list:
    """As ``to_pylist``, which makes a scalar of each value first."""
    return values.to_numpy(zero_copy_only=False).tolist()


class WordCoder:
    """Encodes texts with a tokenizer that lets no piece span white space.

    As white space only ends pieces there, a text's ids are the ids of its words put
    together. Each distinct word of a slice of texts is looked at once. Plain words, letters
    with end marks, are made of pieces, which are kept up to ``most_bytes``, as are the other
    words up to a quarter of it; what is forgotten is encoded again. Ids are kept as
    little-endian integers of 16 bits, or 32 where the vocabulary needs them.
    """

    def __init__(self, path: str, most_bytes: int = 24 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.words = Remembered(self._word, most_bytes // 4)
        self.end = np.array([END_ID], self.dtype).tobytes()
        probe = "Ab \n'S cd. <|x|>  \t9é"
        if self._ids(probe) != [i for w in probe.split() for i in self._ids(w)]:
            raise ValueError(f"{path}: pieces may span white space")
        self.pieces = Remembered(self._piece, most_bytes)
        probe = ["Éabcdñß!,", f"Ab{MARKS}", "ſĿ", "ab"]
        whole = [np.array(self._ids(word), self.dtype).tobytes() for word in probe]
        self.split = self._plain(pa.array(probe, pa.large_string())) == whole

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> bytes:
        """Ids of lower-case letters or of end marks, from the tokenizer's model alone."""
        shown = piece if piece.isascii() else "".join(map(_SHOWN.__getitem__, piece.encode()))
        return np.array([token.id for token in self.tokenizer.model.tokenize(shown)], self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        return np.array(self._ids(word), self.dtype).tobytes()

    def _plain(self, words: pa.Array) -> list[bytes]:
        """Ids of plain words."""
        letters = pc.utf8_lower(pc.utf8_rtrim(words, MARKS)).dictionary_encode()
        marks = pc.replace_substring_regex(words, LEADING, "").dictionary_encode()
        heads = list(map(self.pieces.__getitem__, _listed(letters.dictionary)))
        tails = [self.pieces[m] if m else b"" for m in _listed(marks.dictionary)]
        places = zip(_listed(letters.indices), _listed(marks.indices))
        return [heads[i] + tails[j] for i, j in places]

    def _distinct(self, words: pa.Array) -> list[bytes]:
        """Ids of each of the words."""
        if not self.split:
            return [self.words[w] for w in _listed(words)]
        plain = pc.match_substring_regex(words, PLAIN)
        ids = iter(self._plain(words.filter(plain)))
        others = iter(_listed(words.filter(pc.invert(plain))))
        return [next(ids) if p else self.words[next(others)] for p in _listed(plain)]

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (null: empty) and the end id, as arrays of ``dtype``."""
        texts = texts.cast(pa.large_string()).fill_null("")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = self._distinct(words.dictionary)
        width = len(self.end)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        firsts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(ids), self.dtype)
        codes = words.indices.to_numpy()
        counts = pc.list_value_length(split).to_numpy()
        start = 0
        for count in counts.tolist():
            own = codes[start : start + count]
            start += count
            length = sizes[own]
            ends = np.cumsum(length)
            n = int(ends[-1]) if count else 0
            out = np.empty(n + 1, self.dtype)
            out[:n] = ids[np.repeat(firsts[own] - ends + length, length) + np.arange(n)]
            out[n] = END_ID
            yield out

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text and the end id, as bytes of ``dtype``."""
        (ids,) = self.encode_all(pa.array([text.decode()], pa.large_string()))
        return ids.tobytes()


def coder(path: str) -> WordCoder:
    """The coder of this Python worker, kept from task to task."""
    return kept(("tokens", path), lambda: WordCoder(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
