"""Token records and packing against the library itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import packing, token_records
from tickloom.llm.staging import new_folder, open_store
from tickloom.llm.token_ids import default_path, encoder
from tickloom.llm.words import text_bytes

from .cases import documents, odd_texts


def library_ids(text):
    return encoder(default_path()).library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abZé ßñ×'stremvdl\n\t \r0½9.,!<|>endoftx“\u00a0\u2028\x1c中")), max_size=30), max_size=4))
def test_encoder_gives_the_librarys_ids(texts):
    ids, at = encoder(default_path()).encode(*text_bytes(pa.array(texts, pa.string())))
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == [library_ids(t) for t in texts]


def test_records_round_trip(spark):
    docs = documents(spark)
    folder = new_folder(spark, "test")
    index = token_records.write_records(docs, folder, default_path())
    got = token_records.read_records(index, folder).collect()
    want = Counter((i, crc([*library_ids(t), 0])) for i, t in odd_texts())
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in got) == want
    shuffled = token_records.read_records(token_records.shuffled(index, 5).coalesce(1), folder).collect()
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in shuffled) == want
    assert [r.offset for r in shuffled] != [r.offset for r in got]
    ordered = sorted(index.join(token_records.shard_starts(index), "shard").collect(), key=lambda r: r.start + r.base)
    keys = [(r.doc_id is not None, r.doc_id) for r in ordered]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
    assert [r.start + r.base for r in ordered] == [sum(x.n_tokens for x in ordered[:n]) for n in range(len(ordered))]


def test_damage_is_found(spark):
    folder = new_folder(spark, "test")
    index = token_records.write_records(documents(spark, [(1, "some text")]), folder, default_path())
    row = index.first()
    store, base = open_store(f"{folder}/data")
    with store.open_input_file(f"{base}/{row.shard}") as f:
        data = bytearray(f.read())
    data[20] ^= 1
    with store.open_output_stream(f"{base}/{row.shard}") as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        token_records.read_records(index, folder).collect()


def test_frame():
    ids = np.array([5, 50_000], np.dtype("<u2"))
    raw = token_records.frame(None, ids)
    key, back = token_records.unframe(memoryview(raw))
    assert key is None and back.tolist() == [5, 50_000]
    assert token_records.unframe(memoryview(token_records.frame(-7, ids)))[0] == -7


def test_empty_table(spark):
    folder = new_folder(spark, "test")
    assert token_records.write_records(documents(spark, []), folder, default_path()).count() == 0
    assert packing.packed_documents(documents(spark, [])).count() == 0


def test_packing(spark):
    rows = odd_texts()
    got = packing.pack(documents(spark), size=64).collect()
    want = Counter((i, tuple([*library_ids(t), 1])) for i, t in rows)
    pieces = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 2 <= 64
        pieces[r.sequence_id].append(r)
    for group in pieces.values():
        group.sort(key=lambda r: r.offset)
        assert [r.offset for r in group] == [sum(x.length for x in group[:n]) for n in range(len(group))]
        assert sum(r.length for r in group) <= 64
    # equal rows have equal pieces, so documents are rebuilt from the counts of their pieces
    parts = Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in got)
    assert parts == Counter((i, s, len(ids), np.array(ids[s : s + 64], "<u2").tobytes()) for (i, ids), n in want.items() for s in range(0, len(ids), 64) for _ in range(n))
    assert all(r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) for r in got)


def test_places_without_ids(spark):
    both = [sorted(packing.pack(documents(spark), size=64, with_ids=w).drop("ids").collect(), key=repr) for w in (True, False)]
    assert "ids" not in packing.pack(documents(spark), size=64, with_ids=False).columns
    strip = lambda rows: Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in rows)
    assert strip(both[0]) == strip(both[1])


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=30))
def test_patterns_hold_every_piece_once(histogram):
    patterns = packing.pack_histogram(histogram, 50)
    assert all(sum(p) <= 50 for p, _ in patterns)
    placed = Counter()
    for pattern, n in patterns:
        for length in pattern:
            placed[length] += n
    assert placed == Counter(histogram)
    assert len(patterns) <= 4 * 50 * 4


def test_little_padding():
    r = np.random.default_rng(1)
    lengths = np.concatenate([r.integers(1, 2049, 20_000), r.integers(1, 300, 60_000)])
    patterns = packing.pack_histogram(dict(Counter(lengths.tolist())), 2048)
    assert lengths.sum() / (2048 * sum(n for _, n in patterns)) > 0.99
    assert len(patterns) < 20_000
