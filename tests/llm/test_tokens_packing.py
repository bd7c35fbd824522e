import random
import sys
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from helpers import edge, edge_rows, empty  # noqa: E402

from wardflow.llm import bytebpe, packing, tokens  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(library):
    r = random.Random(5)
    pool = "  \n\t'''sstredmvl LL'S aé9½\u0085\x1c.,!ѣ"
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(r.choice([r.randrange(1, 0x700), 32, 39, 115])) for _ in range(15)) for _ in range(1500)]
    texts += [t for _, t, *_ in edge_rows()]
    got, at = bytebpe.Encoder.of(PATH).encode(pa.array(texts))
    for t, a, b in zip(texts, at[:-1], at[1:]):
        assert got[a:b].tolist() == ids(library, t), repr((t or "")[:80])


def test_every_known_character_is_cut_as_the_library_does(library):
    texts = [f"a{chr(c)}a 1{chr(c)}1 .{chr(c)}. {chr(c)} {chr(c)}{chr(c)}" for c in range(1, bytebpe.KNOWN)]
    got, at = bytebpe.Encoder(PATH).encode(pa.array(texts))
    assert [got[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids(library, t) for t in texts]


def test_safe_parts_keep_the_tokens(library):
    r = random.Random(6)
    text = "".join(r.choice(["word", " ", "  ", "\n", "x1", "'s", ". "]) for _ in range(3000))
    parts = bytebpe.safe_parts(text, 100)
    assert "".join(parts) == text and max(map(len, parts)) <= 100
    assert sum((ids(library, p) for p in parts), []) == ids(library, text)
    assert bytebpe.safe_parts("x" * 500, 100) == ["x" * 500]


def test_counts(spark, library):
    got = tokens.count_tokens(edge(spark), PATH).collect()
    want = [(i, len((t or "").encode()), len(ids(library, t)), len(ids(library, t)) > 512) for i, t, *_ in edge_rows()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tokens.count_tokens(empty(spark), PATH).count() == 0


def test_counts_of_a_sentence_piece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = tokens.count_tokens(edge(spark), path).collect()
    assert sorted((r.n_tokens for r in got)) == sorted(len(model.encode(t or "")) for _, t, *_ in edge_rows())


@pytest.mark.parametrize("keep", [True, False])
def test_pack_is_an_exact_cover(spark, library, keep):
    size = 256
    docs = edge(spark).repartition(5)
    got = packing.pack(docs, PATH, size=size, open_windows=4, keep_ids=keep).collect()
    pieces, windows = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    want = {}
    for i, t, *_ in edge_rows():
        want.setdefault((i, len(ids(library, t)) + 1), []).append(ids(library, t) + [1])
    assert set(pieces) == set(want)
    for key, texts in want.items():
        rows = sorted(pieces[key], key=lambda r: r.start)
        assert sum(r.length for r in rows) == key[1] * len(texts)
        for r in rows:
            piece = [t[r.start:r.start + r.length] for t in texts]
            assert r.ids_crc32 in [bytebpe.digest(np.asarray(p)) for p in piece]
            if keep:
                assert np.frombuffer(r.ids, "<u4").tolist() in piece
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    total = sum(r.length for r in got)
    assert len(windows) * size - total <= 7 * len(windows) + size  # gaps under min_cut, and one last window
    assert packing.pack(empty(spark), PATH).count() == 0


def test_packer_holds_a_fixed_number_of_windows():
    out = []
    p = packing.Packer(100, 3, 8, out.append)
    r = random.Random(1)
    for d in range(400):
        p.document(d, np.arange(r.randint(1, 250), dtype=np.uint32))
        assert len(p.windows) <= 3 and all(0 < f < 100 for f in p.filled)
    last = p.leftover()
    assert sum(len(x[2]) for x in last) < 100
    assert all(93 <= sum(len(x[2]) for x in w) <= 100 for w in out)
