"""Token ids of whole texts from a public tokenizer file.

Both vocabularies in use split text before they merge: in front of white space, and
between letters and punctuation. A text's ids are therefore the ids of its pieces
(a run of white space with the word behind it, or a run of punctuation), end to end. A
worker encodes each distinct piece once and keeps a bounded store of those it has
seen. Cuts are made between ASCII characters only, and none behind an apostrophe,
which may start a contraction; texts with white space outside ASCII, or with the name of a
control token unless that is to be plain text, go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodeworks.llm.common import ragged, text_bytes
from lodeworks.llm.words import LOWER

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
ASCII_POINT = np.zeros(256, bool)
ASCII_POINT[33:127] = True
ASCII_POINT[48:58] = False
ASCII_POINT &= ~ASCII_LETTER
POINT_BEFORE = ASCII_POINT.copy()
POINT_BEFORE[39] = False
OTHER_SPACE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Distinct pieces a worker keeps (about 60 MB) before it starts afresh.
STORED_PIECES = 1_200_000

#: Lower-case letters of ASCII and Latin-1, each a letter by itself in any normal form.
LETTER_RUN = r"^ ?[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+$"
#: A control character that separates pieces encoded in one call.
MARK = "\x01"

_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, plain_text: bool = False) -> PieceEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks (see ``PieceEncoder``)."""
    if (path, plain_text) not in _encoders:
        _encoders[path, plain_text] = PieceEncoder(path, plain_text)
    return _encoders[path, plain_text]


class PieceEncoder:
    """The ids that the tokenizer of a file gives whole texts.

    The name of a control token inside a text becomes that token, as the library has it;
    with ``plain_text`` it is encoded like any other text.
    """

    def __init__(self, path: str, plain_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain_text
        self._names = None if plain_text else self._control_names()
        ids = lambda x: self._tokenizer.encode(x, add_special_tokens=False).ids
        self._drops_space = ids(" a\n. b ") == ids("a . b")
        self._lowers = ids("A") == ids("a") and ids("ZQ") == ids("zq")
        self._separator = f" {MARK} " if self._drops_space else f" {MARK}"
        self._separator_ids = ids(self._separator)
        self._words = self._word_model() if self._drops_space and self._lowers else None
        self._forget()

    def _control_names(self) -> str | None:
        """A pattern that finds every text that may name a token added to the vocabulary."""
        added = self._tokenizer.get_added_tokens_decoder().values()
        names = sorted({token.content.strip() for token in added})
        return "(?i)" + "|".join(map(re.escape, names)) if names else None

    def vocabulary(self) -> list[str]:
        """The token of each id."""
        known = self._tokenizer.get_vocab()
        tokens = [""] * (max(known.values()) + 1)
        for token, i in known.items():
            tokens[i] = token
        return tokens

    def _word_model(self):
        """The tokenizer's model behind a split at line ends alone, and which ids end a word.

        For lower-case letter runs the file's normalizer and pattern change nothing, but
        take most of the time. None if the vocabulary does not mark the ends of words.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        words = Tokenizer(self._tokenizer.model)
        words.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.CharDelimiterSplit("\n"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self._tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return words, ends

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of ``LETTER_RUN`` letters, with or without a blank before them."""
        model, ends = self._words
        text = "\n".join(words).replace(" ", "")
        ids = np.array(model.encode(text, add_special_tokens=False).ids, np.int32)
        return ids, np.diff(np.flatnonzero(ends[ids]), prepend=-1)

    def _forget(self) -> None:
        self._pieces = pa.array([], pa.large_string())
        self._ids = np.zeros(0, np.int32)
        self._ends = np.zeros(1, np.int64)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [
            x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.concatenate([np.array(x, np.int32) for x in found] or [np.zeros(0, np.int32)])
        return ids, counts

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that do not hold the mark and, unless the tokenizer drops
        white space, begin with it.

        Behind each piece stand a blank and the mark, which no piece merges with, so that
        one call encodes many pieces and the mark's id tells them apart.
        """
        text = self._separator.join([*pieces, ""])
        ids = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        marks = np.flatnonzero(ids == self._separator_ids[-1])
        extra = len(self._separator_ids)
        counts = np.diff(marks, prepend=-1) - extra
        kept = np.ones(len(ids), bool)
        for back in range(extra):
            kept[marks - back] = False
        return ids[kept], counts

    def _learn(self, pieces: pa.Array) -> None:
        texts = pieces.to_pylist()
        simple = np.array([(self._drops_space or x[0] in " \n\t\r") and MARK not in x for x in texts])
        letters = np.zeros(len(texts), bool)
        if self._words:
            letters = pc.match_substring_regex(pieces, LETTER_RUN).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        parts, order = [], []
        for kind, way in ((letters, self._letters), (simple & ~letters, self._joined)):
            rows = np.flatnonzero(kind)
            for first in range(0, len(rows), 2000):
                some = rows[first : first + 2000]
                ids, counts[some] = way([texts[k] for k in some])
                parts.append(ids)
                order.append(some)
        others = np.flatnonzero(~simple & ~letters)
        ids, counts[others] = self._plain([texts[k] for k in others])
        parts.append(ids)
        order = np.concatenate((*order, others))
        begins = np.zeros(len(texts), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        new = np.concatenate(parts)[ragged(begins, counts)]
        self._pieces = pa.concat_arrays([self._pieces, pieces])
        self._ids = np.concatenate((self._ids, new))
        self._ends = np.concatenate((self._ends, self._ends[-1] + np.cumsum(counts)))

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        space = ASCII_SPACE[data]
        if self._drops_space:
            data = np.where(space, np.uint8(32), data)
        if self._lowers:
            data = LOWER[data]
        letter = ASCII_LETTER[data]
        starts = np.zeros(len(data), bool)
        starts[1:] = (
            (space[1:] & ~space[:-1])
            | (letter[:-1] & ASCII_POINT[data[1:]])
            | (POINT_BEFORE[data[:-1]] & letter[1:])
        )
        starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(starts)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts),
            pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(data)),
        )
        coded = pieces.dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self._pieces)
        if len(self._pieces) + known.null_count > STORED_PIECES:
            self._forget()
            known = pc.index_in(coded.dictionary, value_set=self._pieces)
        places = pc.fill_null(known, -1).to_numpy()
        new = places < 0
        if new.any():
            places = places.copy()
            places[new] = len(self._pieces) + np.arange(np.count_nonzero(new))
            self._learn(coded.dictionary.filter(pa.array(new)))
        places = places[coded.indices.to_numpy()]
        counts = (self._ends[1:] - self._ends[:-1])[places]
        ids = self._ids[ragged(self._ends[:-1][places], counts)]
        ends = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(ends[np.searchsorted(starts, offsets)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text (null: none)."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, OTHER_SPACE)
        if self._names:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self._names))
        if not pc.any(odd).as_py():
            return self._by_pieces(texts)
        odd = odd.to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        parts = []
        for rows, way in (
            (np.flatnonzero(~odd), self._by_pieces),
            (np.flatnonzero(odd), lambda x: self._plain(x.to_pylist())),
        ):
            ids, counts[rows] = way(texts.take(pa.array(rows)))
            parts.append(ids)
        order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
        begins = np.zeros(len(texts), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(parts)[ragged(begins, counts)], counts


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` behind each text's ids; also where each text begins."""
    ends = np.cumsum(counts + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
    out[ragged(ends - counts - 1, counts)] = ids
    return out, np.concatenate(([0], ends))
