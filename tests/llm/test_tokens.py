"""Token operators against the tokenizers library, document by document."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from obsgate.llm import token_counts as TC
from obsgate.llm.packing import pack
from obsgate.llm.token_counts import Counter
from obsgate.llm.token_records import frame, read_index, read_shuffled, token_records, unframe, write_records
from obsgate.llm.tokens import PieceEncoder, default_tokenizer


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(default_tokenizer())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_encode_like_whole_texts(tok):
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "a", "ab", "'s", ".", ",", "1", "é", " ", "!", "<|endoftext|>", "　", "\x1c", "中", "\r", "\x85"]
    enc = PieceEncoder(default_tokenizer(), 50)
    for _ in range(3000):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3)]
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_token_records(request, tok, which):
    df, rows = request.getfixturevalue(which)
    start, want = 0, []
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_records(df).collect()), key=lambda r: r[1])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = defaultdict(list)
    for i, t in order:
        by_id[i].append([*tok.encode(t or "", add_special_tokens=False).ids, 0])
    for i, s, n, c in got:
        match = next(x for x in by_id[i] if (len(x), crc(x)) == (n, c))
        by_id[i].remove(match)
        want.append((i, start))
        start += n
    assert [(i, s) for i, s, _, _ in got] == want and not any(by_id.values())
    assert [i for i, *_ in got] == [i for i, _ in order]


def test_records_round_trip(spark, documents, tok, tmp_path, empty):
    df, rows = documents
    path = f"file://{tmp_path}/records"
    write_records(df.repartition(3), path, shard_bytes=30_000)
    index = read_index(spark, path)
    assert index.select("part").distinct().count() > 3
    ids = [i for i, _ in rows]
    random.Random(4).shuffle(ids)
    order = spark.createDataFrame(list(enumerate(ids)), "position long, doc_id long")
    texts = dict(rows)
    got = read_shuffled(spark, path, order).collect()
    assert [(r.doc_id, r.ids) for r in got] == [(i, [*tok.encode(texts[i], add_special_tokens=False).ids, 0]) for i in ids]
    data = frame(b"abc") + b"\n" + frame(b"") + b"\n"
    first, at = unframe(data, 0)
    assert (first, unframe(data, at)) == (b"abc", (b"", len(data)))
    for k in (0, 9, 13, 16):
        with pytest.raises(ValueError):
            unframe(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :], 0)
    assert token_records(empty).count() == 0


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_packing(request, tok, which):
    df, rows = request.getfixturevalue(which)
    pieces = pack(df).collect()
    docs = defaultdict(list)
    for i, t in rows:
        docs[i].append([*tok.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(docs)
    for i, own in by_doc.items():
        if len(docs[i]) == 1:
            ids, at = docs[i][0], 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == crc(ids[at : at + p.length])
                at += p.length
            assert at == len(ids)
        assert sum(p.length for p in own) == sum(map(len, docs[i]))
    padding = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_packing_empty(empty):
    assert pack(empty).count() == 0


# --- counts by the compiled transducers


def test_counts_equal_the_library(tok):
    rng = random.Random(12)
    bits = [" ", "  ", "\n", "\t", "a", "ab", "'s", "'", "'re", "'l", "'ll", "'v", "'d", ".", ",", "1", "é", "\xa0", "!", "<|endoftext|>", "　", "\x1c", "中", "\r", "\x85", "́", "x" * 30, "ing", "the", "Ünï", "🙂", "r", "e", "s"]
    machine = Counter(default_tokenizer(), 1 << 14, 2_000)  # a table that is started anew many times
    for _ in range(1500):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4)]
        assert machine.count(texts).tolist() == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    texts = ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(97, 122), rng.randint(0, 0xD7FF)])) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += ["".join(rng.choice("abcdeé") for _ in range(20_000)), "x" * 5_000, " " * 999, "ab " * 3_000]
    assert machine.count(texts).tolist() == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_token_counts(request, tok, which, monkeypatch):
    monkeypatch.setattr(TC, "BLOCK", 500)
    df, rows = request.getfixturevalue(which)
    got = sorted(map(tuple, TC.token_counts(df).collect()), key=str)
    sizes = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert got == sorted(((i, b, n, n > 1024) for i, b, n in sizes), key=str)


def test_token_counts_of_nothing(empty):
    assert TC.token_counts(empty).collect() == []


def test_chunk_maps_compose():
    rng = np.random.default_rng(9)
    cls = rng.integers(0, TC.N_CLASSES, (50, 7)).astype(np.uint8)
    scanned = TC.prefix_scan(TC.chunk_maps(cls))
    for entered in range(TC.N_STATES):
        state = entered
        for k, row in enumerate(cls):
            for c in row:
                state = TC.split_step(state, int(c))[0]
            assert scanned[k, entered] == state
    flat = cls.ravel()
    assert all((TC.piece_starts(flat, c) == TC.piece_starts(flat, 1000)).all() for c in (1, 2, 13))


def test_other_tokenizers_are_refused(tmp_path):
    import public_tokenizers

    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        with pytest.raises(ValueError):
            Counter(public_tokenizers.path(name))
