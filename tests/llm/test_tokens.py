import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from alertloom.llm import bpe, dac, packing
from alertloom.llm.common import text_bytes


@pytest.fixture(scope="module")
def encoder():
    return bpe.PieceEncoder(bpe.vocabulary_path())


def _ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_texts(encoder):
    rng = np.random.default_rng(1)
    signs = np.array([*"ab Z9'.,$\n\t é漢　\xa0“’s!-\r\x1c", "  ", "<|endoftext|>", "'s", "\r\n", " \n "], dtype=object)
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)]
    data, offsets = text_bytes(pa.array(texts))
    ids, count = encoder.encode(data, offsets)
    bounds = np.append(0, np.cumsum(count))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == _ids(encoder, t), repr(t)


def test_long_text_in_parts(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 256)
    monkeypatch.setattr(bpe, "worker_state", lambda key, make: encoder)
    texts = ["some words, here and\n\nthere  are many. " * 200, "y" * 3000, "é漢 " * 900, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    out = []
    for _, ids, bounds in bpe.encoded_texts(iter([batch]), "x", 2):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert out == [[*_ids(encoder, t), 2] for t in texts]


def test_dac_round_trip_and_access():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 60000, 3000).astype(np.uint32)
    ids[::3] = rng.integers(0, 256, 1000)
    ids[17] = 20_000_000
    found = dac.DacFile(dac.pack([1, None, 3], np.array([10, 10, 3000]), ids))
    assert (found.all() == ids).all() and found.doc_ids == [1, None, 3] and found.ends.tolist() == [10, 10, 3000]
    assert [found.token(i) for i in range(3000)] == ids.tolist()
    with pytest.raises(IndexError):
        found.token(3000)
    none = dac.DacFile(dac.pack([], np.zeros(0, int), np.zeros(0, np.uint32)))
    assert none.tokens == 0 and len(none.all()) == 0


def test_files_hold_every_document(spark, docs, rows, encoder, tmp_path):
    files = dac.write_ids(docs, str(tmp_path), per_file=64)
    found = sorted(dac.read_ids(files).collect(), key=lambda r: r.start)
    at = 0
    ordered = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for r, (i, text) in zip(found, ordered, strict=True):
        ids = [*_ids(encoder, text), 2]
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    empty = dac.read_ids(dac.write_ids(docs.limit(0), f"{tmp_path}/none"))
    assert empty.count() == 0


def test_packing(spark, docs, rows, encoder):
    pieces = packing.pieces(docs)
    found = packing.placed(pieces)
    whole = {r.sequence_id: r for r in packing.sequences(found).collect()}
    per_row = defaultdict(list)
    for r in found.collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 2048
        assert whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        per_row[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
    assert sum(w.length for w in whole.values()) == sum(len(x[2]) for v in per_row.values() for x in v)
    for w in whole.values():
        assert w.length == len(w.ids) // 4 <= 2048
    for i, t, *_ in rows:
        ids = [*_ids(encoder, t), 1]
        starts = sorted(per_row[i])
        twice = 2 if i == 16 else 1
        assert [x for s in starts for x in s[2]] == (ids if twice == 1 else ids * 2)
        assert all(n == len(ids) for _, n, _ in starts)
    assert packing.pack(docs.limit(0)).count() == 0


def test_cutting_stock_meets_demand_closely():
    rng = np.random.default_rng(4)
    demand = {int(s): int(rng.integers(1, 4000)) for s in rng.choice(np.arange(1, 65), 40, replace=False)}
    plan = packing.cutting_stock(demand, 64)
    used = defaultdict(int)
    for pattern, times in plan:
        assert sum(s * c for s, c in pattern.items()) <= 64
        for s, c in pattern.items():
            used[s] += c * times
    assert dict(used) == demand
    assert sum(t for _, t in plan) <= 1.02 * max(sum(s * n for s, n in demand.items()) / 64, sum(n for s, n in demand.items() if s > 32)) + 20
    assert packing.cutting_stock({}, 64) == []
    assert packing.cutting_stock({64: 3}, 64) == [({64: 1}, 3)]


def test_ids_of_the_library_defaults(encoder, monkeypatch):
    """Added tokens in a text get their ids, as by a tokenizer that nothing was set on."""
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(bpe.vocabulary_path())
    want = lambda t: fresh.encode(t, add_special_tokens=False).ids
    assert want("a <|endoftext|> b") == [64, 220, 50256, 275]
    texts = ["a <|endoftext|> b", "plain text, here", "<|endoftext|>", "x<|endoftext|><|endoftext|>y.", "<|endoftext", "|>", "no\xa0<|endoftext|>\n z"]
    data, offsets = text_bytes(pa.array(texts))
    ids, count = encoder.encode(data, offsets)
    assert np.split(ids, np.cumsum(count)[:-1])[0].tolist() == want(texts[0])
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [want(t) for t in texts]
    monkeypatch.setattr(bpe, "CHUNK", 64)
    monkeypatch.setattr(bpe, "worker_state", lambda key, make: encoder)
    long = "some words <|endoftext|> and more,<|endoftext|>\n\nof them. " * 100
    out = list(bpe.encoded_texts(iter([pa.RecordBatch.from_arrays([pa.array([long])], names=["text"])]), "x", 2))
    assert out[0][1].tolist() == [*want(long), 2]


def test_short_pieces_fill_sequences():
    """Tables of one short length come close to the most that fits a sequence, and mixed ones to no padding."""
    rng = np.random.default_rng(5)
    for lengths in (np.full(5000, 1), np.full(5000, 9), np.full(5000, 57), rng.integers(1, 65, 5000), rng.integers(1, 300, 3000)):
        kinds = packing.classes()[lengths]
        assert (kinds >= lengths).all() and (kinds[lengths <= 64] == lengths[lengths <= 64]).all()
        demand = dict(zip(*(v.tolist() for v in np.unique(kinds, return_counts=True)), strict=True))
        plan = packing.cutting_stock(demand, packing.LENGTH, packing.UNIT)
        used = defaultdict(int)
        for pattern, times in plan:
            assert sum(s * c for s, c in pattern.items()) <= packing.LENGTH
            for s, c in pattern.items():
                used[s] += c * times
        assert dict(used) == demand
        sequences = sum(t for _, t in plan)
        one = len(demand) == 1 and -(-len(lengths) // (packing.LENGTH // int(lengths[0])))
        assert sequences <= (one or 1.02 * lengths.sum() / packing.LENGTH) + 1


def test_a_program_cut_short_warns_and_is_whole(monkeypatch):
    monkeypatch.setattr(packing, "MOST_COLUMNS", 1)
    with pytest.warns(UserWarning, match="stopped after 1 columns"):
        plan = packing.cutting_stock({3: 50, 5: 70, 7: 20, 11: 9}, 64)
    used = defaultdict(int)
    for pattern, times in plan:
        for s, c in pattern.items():
            used[s] += c * times
    assert dict(used) == {3: 50, 5: 70, 7: 20, 11: 9}
