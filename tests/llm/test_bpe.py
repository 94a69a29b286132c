"""BPE against the tokenizers library, and both merge loops against each other."""

import hashlib
import random

import pytest

from tests.llm.conftest import prose
from tidepool.llm import bpe
from tidepool.llm.catalog import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    return tokenizers.Tokenizer.from_file(vocabulary()), bpe.load(vocabulary())


def odd_texts():
    rng = random.Random(2)
    ranges = ((32, 127), (1, 0x250), (0x370, 0x600), (0x2000, 0x2100), (0x1F000, 0x1FA00), (0xAC00, 0xAD00))
    made = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    return ["", " ", "a" * 3000, "Σίσυφος ΣΑΣ", "İstanbul",
            "<|endoftext|>x<|startoftext|>Y <|ENDOFTEXT|>", "\x1c\x1f a\u0085b c d", "é é Å", "it's 'S we'LL can't",
            "123 ½ ²", "ab" * 700 + "!" * 999, prose(rng, 3000), *made]


def test_ids_and_text(pair):
    theirs, ours = pair
    for t in odd_texts():
        ids = theirs.encode(t, add_special_tokens=False).ids
        assert ours.encode(t) == ids
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_every_code_point(pair):
    theirs, ours = pair
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for k in range(0, len(points), 4096):
        text = "\n".join(f"a{chr(c)}b 1{chr(c)}1 {chr(c)}" for c in points[k:k + 4096])
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids, hex(points[k])


def test_scan_equals_heap(pair):
    ours, rng = pair[1], random.Random(4)
    for _ in range(300):
        word = "".join(rng.choices("theionandst", k=rng.randrange(1, 60))).encode()
        parts = [ours.first[b] for b in word[:-1]] + [ours.last[word[-1]]]
        assert ours._merge_scan(list(parts)) == ours._merge_heap(list(parts))


def test_table(pair, odd, odd_rows, empty):
    theirs, ours = pair
    out = bpe.token_digests(odd, ours)
    assert set(out.columns) == {*odd.columns, "n_tokens", "ids_sha256", "decoded_sha256"}
    expected = []
    for r in odd_rows:
        ids = theirs.encode(r[1] or "", add_special_tokens=False).ids
        expected.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert bpe.token_digests(empty, ours).count() == 0


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.load(vocabulary("byte_bpe_50k.json"))
