"""Wavelet matrix against plain arrays, encoding against the library, and the store's round trip."""

import random
import uuid
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidepool.llm import token_store
from tidepool.llm.catalog import vocabulary
from tidepool.llm.wavelet import WaveletMatrix

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ours():
    return token_store.ByteBpe(vocabulary("byte_bpe_50k.json"))


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 5000, 40_000])
@pytest.mark.parametrize("width", [1, 5, 16, 20])
def test_matrix(n, width):
    rng = np.random.default_rng(n + width)
    ids = np.minimum(rng.zipf(1.3, n), 2 ** width - 1).astype(np.uint32)
    made = WaveletMatrix.of(ids, width)
    m = WaveletMatrix.from_bytes(*made.to_bytes(), n, width)
    assert m.ids().tolist() == ids.tolist()
    at = rng.integers(0, n, 300) if n else np.empty(0, np.int64)
    assert m.access(at).tolist() == ids[at].tolist()
    for token in {0, 1, 2, 2 ** width - 1, int(ids[0]) if n else 3}:
        assert m.places(token).tolist() == np.flatnonzero(ids == token).tolist()
        for upto in {0, n // 2, n}:
            assert m.rank(token, upto) == int((ids[:upto] == token).sum())
    assert m.rank(-1) == m.rank(2 ** width) == len(m.places(2 ** width)) == 0
    with pytest.raises(ValueError):
        WaveletMatrix.of(np.array([2 ** width]), width)


def odd_texts():
    rng = random.Random(3)
    ranges = ((32, 127), (1, 0x250), (0x370, 0x600), (0x2000, 0x2100), (0x1F000, 0x1FA00), (0xAC00, 0xAD00), (0x10D00, 0x11400))
    made = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 60))) for _ in range(500)]
    spaced = ["".join(rng.choice(["a", "Zé", "12", "'s", "'", " ", "  ", "\n", "\t", "\x85", "\xa0", "　", "!", "\x1c", "²"])
                      for _ in range(rng.randrange(1, 40))) for _ in range(800)]
    return ["", " ", "a" * 3000, " \n " * 500, "<|endoftext|>", "x<|endoftext|> y <|endoftext|", prose(rng, 4000), "it's we'LL '''s",
            *made, *spaced]


def test_encoding(library, ours):
    encode = ours.encoder()
    texts = odd_texts()
    for t, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert encode([]) == [] and encode([""]) == [b""]


def test_every_code_point(library, ours):
    """Beside letters, digits, marks and spaces every code point is cut as the library cuts it."""
    encode = ours.encoder()
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lead in ("a", "1! "):
        for k in range(0, len(points), 1 << 16):
            t = "".join(lead + chr(c) + "\n" for c in points[k:k + (1 << 16)])
            cut = [t[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(t)]
            assert ours.pieces(t) == cut
    assert encode(["aᲉ"])[0] == np.array(library.encode("aᲉ").ids, dtype="<u4").tobytes()


def test_remembered_pieces_are_bounded(library, ours, monkeypatch):
    monkeypatch.setattr(token_store, "REMEMBERED", 40)
    encode, rng = ours._encoder(), random.Random(1)
    for _ in range(50):
        t = prose(rng, 20)
        assert np.frombuffer(encode([t])[0], dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_common_pieces_stay_remembered(library, ours, monkeypatch):
    """What every text holds is encoded once, however many other pieces come and go; what was last met long ago is forgotten."""
    calls, real = Counter(), tokenizers.Tokenizer

    class Model:
        def __init__(self, model):
            self.model = model

        def __getattr__(self, name):
            return getattr(self.model, name)

        def tokenize(self, piece):
            calls[piece] += 1
            return self.model.tokenize(piece)

    monkeypatch.setattr(tokenizers, "Tokenizer", SimpleNamespace(from_str=lambda spec: SimpleNamespace(model=Model(real.from_str(spec).model))))
    monkeypatch.setattr(token_store, "REMEMBERED", 200)
    encode, rng = ours._encoder(), random.Random(2)
    for k in range(60):
        t = f"common{' rare' if k in (0, 59) else ''} words{k:03d}<|endoftext|>  \u3000ñandú " + prose(rng, 5)
        assert np.frombuffer(encode([t])[0], dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert (calls["common"], calls["Ġwords"], calls["Ġrare"]) == (1, 1, 2)


def test_distinct_pieces():
    raw = "añb\u3000a ñ".encode()
    words, which = token_store._distinct(raw, np.array([0, 1, 3, 4, 7, 8, 9]))
    assert [words[k].decode() for k in which] == ["a", "ñ", "b", "\u3000", "a", " ", "ñ"] and len(words) == 5


def test_equal_hashes(library, ours, monkeypatch):
    """Pieces of one hash are told apart."""
    monkeypatch.setattr(token_store, "power_table", lambda base, n: np.ones(n, np.uint64))
    encode, texts = ours._encoder(), ["ab ba abc cab", "x", "", "ba ab"]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encode(texts)] == [library.encode(t).ids for t in texts]


def expected(library, rows):
    """{(doc_id, n_tokens, crc)} and the ids in order; rows of one id in any order."""
    out = {}
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.setdefault(i, []).append(ids)
    return out


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_store(spark, odd, odd_rows, library, ours, scratch, size):
    path = f"{scratch}/{uuid.uuid4().hex}"
    token_store.write(odd, path, ours, 2, size=size)
    by_id = expected(library, [r[:2] for r in odd_rows])
    got = sorted(token_store.documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([r[0] for r in odd_rows], key=lambda i: (i is not None, i))
    whole, start = [], 0
    for r in got:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        by_id[r["doc_id"]].remove(ids)
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        whole += ids
        start += len(ids)
    assert not any(by_id.values())
    digests = token_store.document_digests(spark, path).collect()
    assert sorted((r["start"], r["ids_crc32"]) for r in digests) == [(r["start"], zlib.crc32(r["ids"])) for r in got]
    at = [0, 1, 5, len(whole) - 1, len(whole), -1, 1000, 1000, None]
    found = token_store.access(spark, path, spark.createDataFrame([(a,) for a in at], "pos bigint")).collect()
    assert sorted(map(tuple, found)) == [(a, whole[a]) for a in sorted({a for a in at if a is not None and 0 <= a < len(whole)})]
    tokens = [2, whole[7], whole[-2], 50_000, 70_000, 2]
    assert {tuple(r) for r in token_store.count(spark, path, tokens).collect()} == {(t, whole.count(t)) for t in tokens}
    places = token_store.locate(spark, path, tokens).collect()
    assert sorted(map(tuple, places)) == sorted((t, k) for t in set(tokens) for k, x in enumerate(whole) if x == t)


def test_hot_and_empty(spark, empty, library, ours, scratch):
    """A third of the rows share one id, some are equal: several tasks, one order."""
    rows = [(7, f"text {k % 3}") for k in range(400)] + [(None, "none")] * 3 + [(k, f"w{k}") for k in range(800)]
    path = f"{scratch}/{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), path, ours, 2, size=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(token_store.documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]
    parts = spark.read.parquet(f"{path}/shards").selectExpr("part", "explode(doc_ids) i").where("i = 7").select("part").distinct().count()
    assert parts > 1
    none = f"{scratch}/{uuid.uuid4().hex}"
    token_store.write(empty, none, ours, 2)
    assert token_store.documents(spark, none).count() == 0 and token_store.count(spark, none, [2]).collect() == [(2, 0)]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_store.ByteBpe(vocabulary("word_bpe_49k.json"))
