"""Byte-level BPE ids of whole texts by the tokenizers library, with one encoding per distinct piece.

Texts are cut where the tokenizer's own splitting always cuts: before white space that follows
something else, and before ASCII punctuation that follows an ASCII letter. Ids of a text are
then those of its pieces. Pieces are hashed in numpy, and each worker keeps the ids of pieces
it has met, so the library sees every piece once. Texts with white space outside ASCII,
or with the string of an added token (which the library finds before it splits), are encoded whole. Pieces are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from alertloom.llm.common import CHUNK, WHITE, chunks, runs_of, span_hash, text_bytes, worker_state

VOCABULARY = "byte_bpe_50k.json"
MOST_KEPT = 4_000_000

_PUNCTUATION = np.array([chr(c).isprintable() and not chr(c).isalnum() and c != 32 for c in range(128)] + [False] * 128)
_LETTER = np.array([chr(c).isalpha() for c in range(128)] + [False] * 128)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Ids of texts given as bytes and offsets; keeps pieces from call to call."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.newline = self._ids("\n")
        self.breaks = any(b"\n" in t for t in self.added)  # pieces joined by line breaks could make such a token
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encoded(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece. Simple ones are joined by line breaks, which stay tokens of their own."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        simple, broken = [], set()
        for i, p in enumerate(pieces):
            body = p[1:] if p[:1] in (" ", "\n") else p
            if len(self.newline) == 1 and not self.breaks and body.split() == [body]:
                simple.append(i)
                if p[0] == "\n":  # a token of its own before what is no white space
                    broken.add(i)
            else:
                out[i] = self._ids(p)
        for k in range(0, len(simple), 2048):
            part = simple[k : k + 2048]
            ids = self._ids("\n".join([pieces[i].lstrip("\n") for i in part]))
            cuts = np.flatnonzero(ids == self.newline[0])
            ends = np.append(cuts, len(ids))
            begins = np.append(0, cuts + 1)
            for i, a, b in zip(part, begins.tolist(), ends.tolist(), strict=True):
                out[i] = np.append(self.newline, ids[a:b]) if i in broken else ids[a:b]
        return out

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids = self._encoded(pieces)
        count = np.array(list(map(len, ids)), np.int64)
        flat = np.concatenate(ids)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(len(self.store), np.uint32)])
        self.store[self.used : self.used + len(flat)] = flat
        at = np.searchsorted(self.keys, keys)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.keys = np.insert(self.keys, at, keys)
        self.used += len(flat)

    def _some(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without white space outside ASCII, and their number per text."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        white = WHITE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (white[1:] & ~white[:-1]) | (_PUNCTUATION[data[1:]] & _LETTER[data[:-1]])
        cut[offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        keys, sample, piece = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > MOST_KEPT:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)
            self._learn(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            at = np.searchsorted(self.keys, keys)
        count = self.count[at][piece]
        index = np.repeat(self.begin[at][piece], count) + runs_of(count)
        upto = np.append(0, np.cumsum(count))[np.searchsorted(starts, offsets)]
        return self.store[index], np.diff(upto)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their number per text."""
        odd = foreign_space(data)
        strange = np.diff(np.searchsorted(odd, offsets)) > 0
        begins, ends = added_strings(data, self.added)
        if len(begins):
            of = np.searchsorted(offsets, begins, "right") - 1
            strange[of[ends <= offsets[of + 1]]] = True
        if not strange.any():
            return self._some(data, offsets)
        parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
        for i in range(len(counts)):
            a, b = offsets[i], offsets[i + 1]
            if strange[i]:
                ids, n = self._ids(data[a:b].tobytes().decode("utf-8", "replace")), None
            else:
                ids, n = self._some(data[a:b], np.array([0, b - a]))
            parts.append(ids)
            counts[i] = len(ids)
        return np.concatenate(parts), counts


def foreign_space(data: np.ndarray) -> np.ndarray:
    """Places of white space outside ASCII in UTF-8 bytes."""
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if not len(lead):
        return lead
    padded = np.append(data, np.zeros(2, np.uint8))
    one, two, three = data[lead].astype(np.int64), padded[lead + 1], padded[lead + 2]
    code = (one << 16) | (two.astype(np.int64) << 8) | np.where(one == 0xC2, 0, three)
    wide = np.array([0xC28500, 0xC2A000, 0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
    return lead[np.isin(code, wide) | ((code >= 0xE28080) & (code <= 0xE2808A))]


def added_strings(data: np.ndarray, added: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the strings of added tokens, also where they overlap."""
    raw, begins, ends = data.tobytes() if added else b"", [], []
    for token in added:
        at = raw.find(token)
        while at >= 0:
            begins.append(at)
            ends.append(at + len(token))
            at = raw.find(token, at + 1)
    return np.array(begins, np.int64), np.array(ends, np.int64)


def encoder(path: str) -> PieceEncoder:
    return worker_state(("bpe", path), lambda: PieceEncoder(path))


def encoded_texts(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with the ids of their texts, each followed by ``end_id``, and offsets of the texts.

    A text longer than a chunk is encoded in parts cut before white space, so temporary arrays stay small.
    """
    found = encoder(path)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in chunks(offsets):
            at = offsets[first : last + 1]
            parts = [found.encode(data[a:b], o) for a, b, o in _cut(data, at, found.added)]
            count = np.array([sum(int(c[0]) for _, c in parts)]) if len(parts) > 1 else parts[0][1]
            ids = np.concatenate([p for p, _ in parts]) if len(parts) > 1 else parts[0][0]
            bounds = np.append(0, np.cumsum(count + 1))
            out = np.empty(bounds[-1], np.uint32)
            mask = np.ones(len(out), bool)
            mask[bounds[1:] - 1] = False
            out[mask] = ids
            out[~mask] = end_id
            yield batch.slice(first, last - first), out, bounds


def _cut(data: np.ndarray, at: np.ndarray, added: list[bytes] = ()) -> list[tuple[int, int, np.ndarray]]:
    """The range as it is, or parts of its single long text: begin, end, offsets within the part."""
    if len(at) > 2 or at[-1] - at[0] <= 2 * CHUNK:
        return [(at[0], at[-1], at - at[0])]
    begin, stop, parts = int(at[0]), int(at[-1]), []
    # no cut inside an added token's string, nor right behind it, where it may take white space along
    closed = np.zeros(stop - begin + 1, np.int32)
    firsts, lasts = added_strings(data[begin:stop], list(added))
    np.add.at(closed, firsts + 1, 1)
    np.add.at(closed, np.minimum(lasts + 1, len(closed) - 1), -1)
    open_ = np.cumsum(closed) <= 0
    base = begin
    while stop - begin > 2 * CHUNK:
        seen = data[begin + CHUNK : min(begin + 2 * CHUNK, stop)]
        # ASCII white space after an ASCII sign that is none
        free = open_[begin + CHUNK + 1 - base : begin + CHUNK + len(seen) - base]
        good = np.flatnonzero(WHITE[seen[1:]] & ~WHITE[seen[:-1]] & (seen[:-1] < 128) & free)
        end = begin + CHUNK + int(good[0]) + 1 if len(good) else stop
        parts.append((begin, end, np.array([0, end - begin])))
        begin = end
    if begin < stop:
        parts.append((begin, stop, np.array([0, stop - begin])))
    return parts
