"""Token ids of whole texts by a file of the tokenizers library.

A byte-level tokenizer splits a text before it merges bytes: always at a single space or line end that stands between two
characters that are not white space. Texts are cut there and each distinct piece is encoded by the library once and remembered;
the ids are those of the whole text. Texts with other white space, or with two in a row, are encoded as they are.

New pieces that begin with a space are joined again, many at a time, since a call for a text of many pieces costs less than many calls. An
id of a byte-level file stands for as many bytes as its token has letters, which says where each piece's ids end.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Two white-space characters in a row, or one that is neither a space nor a line end, or the mark used for cutting.
ODD = r"[ \n][ \n]|[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
KEPT = 700_000  # pieces remembered by a worker
JOINED = 256  # pieces encoded as one text


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer

        # Spark has a worker for every core: threads of the library's own would only wait for one another.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        # Texts the file sets apart, which may take white space from their neighbours.
        self.apart = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)

    def _singly(self, pieces: list[str]) -> list[bytes]:
        return [array("I", coded.ids).tobytes() for coded in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of a space and other characters each."""
        groups = [pieces[i : i + JOINED] for i in range(0, len(pieces), JOINED)]
        texts = ["".join(g) for g in groups]
        out = []
        for group, text, coded in zip(groups, texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(coded.ids, "<u4")
            ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in group])
            reached = np.cumsum(self.bytes[ids])
            last = np.searchsorted(reached, ends)
            if len(ids) == 0 or last[-1] != len(ids) - 1 or (reached[last] != ends).any() or any(t in text for t in self.apart):
                out += self._singly(group)  # a text set apart, or not a byte-level file
                continue
            raw, cuts = ids.tobytes(), [0, *((last + 1) * 4).tolist()]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(known) + len(new) > self.kept:
            known.clear()
        plain = [i for i in new if pieces[i][:1] == " " != pieces[i]]
        rest = set(new).difference(plain)
        for some, code in ((plain, self._joined), (sorted(rest), self._singly)):
            for start in range(0, len(some), 16 * JOINED):
                part = some[start : start + 16 * JOINED]
                for i, ids in zip(part, code([pieces[i] for i in part])):
                    found[i] = known[pieces[i]] = ids
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin, with the end at last. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, ODD)
        plain = pc.if_else(odd, "", texts)
        cut = pc.replace_substring(pc.replace_substring(plain, "\n", "\0\n\0"), " ", "\0 ")
        lists = pc.split_pattern(cut, "\0")
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        if any(odd.to_pylist()):
            # An odd text takes the place of the single empty piece its cutting left.
            spots = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            whole = [f.ids for f in self.tokenizer.encode_batch_fast([texts[int(i)].as_py() for i in spots], add_special_tokens=False)]
            index = index.copy()
            index[np.asarray(lists.offsets)[spots]] = len(coded.dictionary) + np.arange(len(spots))
            found = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist()) + [np.array(ids, "<u4").tobytes() for ids in whole]
        else:
            found = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        counts = sizes[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], counts) + np.arange(ends[-1])
        return ids[take], ends[np.asarray(lists.offsets)]


@lru_cache(1)
def encoder(path: str, kept: int = KEPT) -> Encoder:
    """The worker's encoder: its pieces stay known from one task to the next."""
    return Encoder(path, kept)


def encoded(texts: pa.Array, with_: Encoder, most: int = 1 << 20):
    """Slices of ``texts`` of at most ``most`` bytes (one text at least) as (first, ids, offsets)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start = 0
    while start < len(sizes):
        total = np.cumsum(sizes[start : start + 4096])
        count = max(1, int(np.searchsorted(total, most, "right")))
        yield start, *with_.encode(texts.slice(start, count))
        start += count


def default_path() -> str:
    """The byte-level file of the installed vocabulary package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
