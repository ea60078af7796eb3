"""Exact encoding of whole texts by their space-separated pieces.

A byte-level tokenizer splits a text so that nothing crosses from a non-space into
the single space before the next word. A text therefore encodes as the sequence of
its pieces, each with the space before it, provided that no piece is empty or begins
or ends with white space, which would join white space across pieces. Texts that
break this, or that hold a special token's string, are encoded whole. Pieces repeat,
so their ids are kept in a table of bounded size; the table never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pullgrid.llm.ragged import gather, offsets

FIRST = "\0"  # marks the first piece of a text, which has no space before it
UNKNOWN, IRREGULAR = -1, -2


class PieceEncoder:
    def __init__(
        self,
        encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        encode_whole: Callable[[str], np.ndarray],
        special: tuple[str, ...],
        table_size: int = 250_000,
    ):
        self.encode_many, self.encode_whole = encode_many, encode_whole
        self.special, self.table_size = special, table_size
        self.codes: dict[str, int] = {}
        self.flat, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _learn(self, unknown: list[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """Codes of new pieces, and all ids and lengths with theirs behind."""
        found, regular = {}, []
        for piece in unknown:
            if not piece:
                bad = True
            elif piece[0] == FIRST:
                bad = len(piece) == 1 or piece[-1].isspace()
            else:
                bad = piece[0].isspace() or piece[-1].isspace()
            if bad:
                found[piece] = IRREGULAR
            else:
                found[piece] = len(self.lengths) + len(regular)
                regular.append(piece)
        if not regular:
            return found, self.flat, self.lengths
        spelled = [p[1:] if p[0] == FIRST else f" {p}" for p in regular]
        ids, lengths = self.encode_many(spelled)
        flat, all_lengths = np.concatenate([self.flat, ids]), np.concatenate([self.lengths, lengths])
        if len(self.codes) < self.table_size:
            self.codes.update(found)
            self.flat, self.lengths = flat, all_lengths
        return found, flat, all_lengths

    def __call__(self, texts: Iterable[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text).

        Arrow splits the texts and tells equal pieces; the table is asked once for each.
        """
        column = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        odd = np.zeros(len(column), bool)
        for string in (FIRST, *self.special):
            odd |= pc.match_substring(column, string).to_numpy(zero_copy_only=False)
        whole = {int(n): column[int(n)].as_py() for n in np.flatnonzero(odd)}
        plain = ~odd & (pc.binary_length(column).to_numpy(zero_copy_only=False) > 0)
        marks = [pa.scalar(c, pa.large_string()) for c in (FIRST, "")]
        marked = pc.binary_join_element_wise(marks[0], column.filter(pa.array(plain)), marks[1])
        split = pc.split_pattern(marked, " ")
        counts = np.zeros(len(column), np.int64)
        counts[plain] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        told = split.flatten().dictionary_encode()
        pieces = told.dictionary.to_pylist()
        codes = np.fromiter(map(self.codes.get, pieces, repeat(UNKNOWN)), np.int64, len(pieces))
        at = np.flatnonzero(codes == UNKNOWN)
        flat, lengths = self.flat, self.lengths
        if len(at):
            missing = [pieces[i] for i in at]
            found, flat, lengths = self._learn(missing)
            codes[at] = np.fromiter(map(found.__getitem__, missing), np.int64, len(at))
        codes = codes[told.indices.to_numpy()]
        bounds = offsets(counts)
        for n in np.unique(np.searchsorted(bounds, np.flatnonzero(codes == IRREGULAR), "right") - 1):
            whole[int(n)] = column[int(n)].as_py()
        if whole:
            codes, bounds, flat, lengths = self._with_whole(whole, codes, bounds, flat, lengths)
        per_piece = lengths[codes]
        ids = gather(flat, offsets(lengths)[codes], per_piece)
        ends = offsets(per_piece)
        return ids, ends[bounds[1:]] - ends[bounds[:-1]]

    def _with_whole(self, whole, codes, bounds, flat, lengths):
        """The texts that are encoded whole stand as one piece each."""
        encoded = [self.encode_whole(whole[n]) for n in sorted(whole)]
        code_of = {n: len(lengths) + k for k, n in enumerate(sorted(whole))}
        flat = np.concatenate([flat, *encoded])
        lengths = np.concatenate([lengths, np.array([len(e) for e in encoded], np.int64)])
        per_text = [
            np.array([code_of[n]]) if n in code_of else codes[bounds[n] : bounds[n + 1]]
            for n in range(len(bounds) - 1)
        ]
        return (
            np.concatenate(per_text).astype(np.int64),
            offsets(np.array([len(p) for p in per_text], np.int64)),
            flat,
            lengths,
        )
