import collections
import itertools
import random
import sys
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siftwork.llm import common, packing, token_files
from siftwork.llm.tokens import UnitEncoder

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "Foo", " ", "  ", "\n", "\t", "\r\n", "'s", "12", ".", "é", "é", "ΑΣ", "日本", "😀", "‍", "᠎", "\xa0", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "İ", " '"]


def ids_of(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_units_give_the_library_s_ids(path):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 12))) for _ in range(6000)]
    enc = UnitEncoder(open(path).read(), "<u4", keep=500, chunk_chars=4000)
    assert enc.mode != "plain"
    for text, raw, ids in zip(texts, enc.encode(texts), ids_of(path, texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == ids, repr(text)


def test_known_units_cost_the_interpreter_nothing():
    """Lookups of units that a chunk repeats are left to C; the interpreter's loops turn for new units only."""
    turns, mon, code = [], sys.monitoring, UnitEncoder.encode.__code__
    enc, texts = UnitEncoder(open(BYTE).read()), ["known words come again " * 5000 + w for w in ("new", "newer")]
    mon.use_tool_id(4, "turns")
    mon.register_callback(4, mon.events.JUMP, lambda *_: turns.append(1))
    mon.set_local_events(4, code, mon.events.JUMP)
    try:
        got = list(enc.encode(texts))
    finally:
        mon.set_local_events(4, code, 0)
        mon.free_tool_id(4)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == ids_of(BYTE, texts) and len(turns) < 100


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_few_units_and_texts_are_held_at_once(path):
    """A worker's memory: a million units at most, and of a batch's texts a slice."""
    enc = UnitEncoder(open(path).read())
    for a in range(0, 1_600_000, 100_000):
        list(enc.encode([" ".join(f"{i:x}" for i in range(a, a + 100_000))]))
        assert len(enc.cache) + len(enc.older) <= 1_200_000
    batch, held = pa.RecordBatch.from_pydict({"doc": list(range(400)), "text": ["some words " * 5000] * 400}), []
    tracemalloc.start()
    for part in common.slices(batch, 1):
        held.append((part.num_rows, sum(map(len, part.column(1).to_pylist()))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for n, _ in held) == 400 and max(b for _, b in held) <= 4_000_000 and peak < 10_000_000
    assert [b.num_rows for b in common.slices(pa.RecordBatch.from_pydict({"doc": [1, 2], "text": pa.array([None, ""])}), 1)] == [2]


def test_files_hold_every_document_in_order(spark, awkward):
    df, rows = awkward
    root = token_files.write_token_files(df, BYTE, end_id=0)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = [x + [0] for x in ids_of(BYTE, [t or "" for _, t in order])]
    data = token_files.TokenDataset(root)
    assert len(data) == len(rows) and [data[i].tolist() for i in range(len(data))] == want
    start, expect = 0, []
    for (doc, _), ids in zip(order, want, strict=True):
        expect.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.read_token_files(spark, root).collect()]
    assert sorted(got, key=lambda r: r[1]) == expect


def test_no_documents_no_shards(spark, nothing):
    root = token_files.write_token_files(nothing, BYTE)
    assert token_files.read_token_files(spark, root).count() == 0 and len(token_files.TokenDataset(root)) == 0


def test_packing_is_whole_gapless_and_tight(spark, awkward):
    df, rows = awkward
    got = packing.pack_documents(df, WORD, capacity=256, end_id=1).collect()
    want = []
    for (doc, _), ids in zip(rows, ids_of(WORD, [t or "" for _, t in rows]), strict=True):
        ids = ids + [1]
        want += [(doc, k, a, len(ids[a : a + 256]), zlib.crc32(np.array(ids[a : a + 256], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, [tuple(r)[:5] for r in got])) == sorted(map(key, want))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= -(-sum(w[3] for w in want) // 256) + 1


def test_packing_tree_rounds_keep_every_piece(spark, prose):
    rows = [(i, prose(5 + i % 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = packing.pack_documents(df, WORD, capacity=128, forward=8, rows_per_task=20).collect()
    assert {r.doc_id for r in got} == set(range(400)) and sum(r.length for r in got) == sum(len(x) + 1 for x in ids_of(WORD, [t for _, t in rows]))
    total = {}
    for r in got:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert max(total.values()) <= 128


def test_packing_of_length_skewed_partitions_is_one_best_fit(spark, prose):
    """Long documents in one partition, short ones in another: still as few sequences as one best-fit."""
    rnd = random.Random(7)
    words = prose(120).replace(".", "").split()
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(24, 30) if i < 150 else rnd.randint(2, 10)))) for i in range(450)]
    df = spark.createDataFrame(rows[:150], "doc_id long, text string").coalesce(1).union(spark.createDataFrame(rows[150:], "doc_id long, text string").coalesce(1))
    got = packing.pack_documents(df, WORD, capacity=128).collect()
    sizes = [len(x) + 1 for x in ids_of(WORD, [t for _, t in rows])]
    best = packing.best_fit([(n, [(i, 0, 0, n, 0, 0)]) for i, n in enumerate(sizes)], 128)
    assert sorted(r.length for r in got) == sorted(sizes) and len({r.sequence_id for r in got}) == len(best)


def test_plan_on_counts_is_best_fit():
    rnd = random.Random(9)
    for low, high in ((1, 100), (30, 60), (1, 9), (100, 100)):
        sizes = [rnd.randint(low, high) for _ in range(2000)]
        runs = packing.plan(dict(collections.Counter(sizes)), 100)
        fill, spans = collections.Counter(), collections.defaultdict(list)
        for size in set(sizes):
            mine = [r for r in runs if r[0] == size]
            for n in range(sizes.count(size)):
                _, first, seq, each, offset = [r for r in mine if r[1] <= n][-1]
                k = seq + (n - first) // each
                fill[k] += size
                spans[k].append((offset + (n - first) % each * size, size))
        bins = packing.best_fit([(s, [(i, 0, 0, s, 0, 0)]) for i, s in enumerate(sizes)], 100)
        assert sorted(fill.values()) == sorted(f for f, _ in bins)
        assert all(a + n == b for xs in spans.values() for (a, n), (b, _) in itertools.pairwise(sorted(xs))) and all(min(xs)[0] == 0 for xs in spans.values())


def test_packing_nothing(nothing):
    assert packing.pack_documents(nothing, WORD).count() == 0


def test_best_fit_against_a_plain_search():
    rnd = random.Random(3)
    sizes = [rnd.randint(1, 100) for _ in range(300)]
    bins = packing.best_fit([(s, [(i, 0, 0, s, 0, 0)]) for i, s in enumerate(sizes)], 100)
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - s)
        else:
            free.append(100 - s)
    assert sorted(100 - f for f, _ in bins) == sorted(free)
