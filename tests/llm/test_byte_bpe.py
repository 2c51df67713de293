"""Operator 11 against the tiktoken library."""

import base64
import hashlib
import random

import pyarrow as pa
import pytest

from tallyload.llm import byte_bpe
from tallyload.llm.byte_bpe import byte_bpe_digests, byte_bpe_encode, library_pattern, read_ranks

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def library(path, pattern=PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def noise(seed, n, alphabet, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


EDGES = ["", None, " ", "a  b", "a \n b", "it's  we'll '", "x<|endoftext|> y", "é z  q", "\x1c a\x1d", " \x85 x", "日本語 テスト 123abc", "😀 😀😀",
         "\x00\x01", "a" * 3000, "-" * 3000, " " * 2000 + "x", "日本語" * 400, "word " * 30_000]


def test_ids_and_bytes_equal_the_library(documents):
    lib = library(RANKS)
    texts = EDGES + noise(1, 200, "abc deT  \n\t.,'!?é日😀0123456789 |<>", 80) + noise(2, 40, "etaoinshrdlu", 300) + noise(3, 6, "ab", 900)
    texts += noise(4, 6, "0123456789", 900)  # past the length where whole rounds are merged
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x y"), (3, "a  b"), (3, "other")]
    got = byte_bpe_encode(documents(rows).repartition(3), RANKS, PATTERN).collect()
    want = sorted((-1 if i is None else i, lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids), bytes(r.decoded)) for r in got) == want
    digests = byte_bpe_digests(documents(rows), RANKS, PATTERN).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests} == {
        (r.doc_id, len(r.ids), hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest(), hashlib.sha256(bytes(r.decoded)).hexdigest())
        for r in got}
    assert byte_bpe_encode(documents([]), RANKS, PATTERN).collect() == []


def test_merges_that_make_lower_pairs_and_tokens_that_merges_do_not_reach(documents, tmp_path):
    tokens = [bytes([b]) for b in range(256)]
    # "bca" ranks below "ca"; "xyz" is no merge of tokens; "aa" twice over
    tokens += [b"ab", b"aa", b"bca", b"ca", b"aaa", b"aaaa", b"xyz", b"abab", b"bab"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    lib = library(str(path))
    texts = ["xyz", "xyzx", "bcaca", "ca", "aaaaaaa", "abababab"] + noise(5, 60, "abcx", 40) + noise(6, 10, "abcxyz", 700)
    got = {r.doc_id: list(r.ids) for r in byte_bpe_encode(documents(list(enumerate(texts))), str(path), PATTERN).collect()}
    assert got == {i: lib.encode_ordinary(t) for i, t in enumerate(texts)}


def test_white_space_is_that_of_the_library():
    find = library_pattern(PATTERN).findall
    assert find("a\x1cb") == ["a", "\x1c", "b"]
    assert find("a \x85 b") == ["a", " \x85", " b"]


def test_a_task_sends_every_word_to_the_fold_once_until_it_forgets(documents, monkeypatch):
    lib, ranks = library(RANKS), read_ranks(RANKS)
    texts = EDGES[:15] + noise(7, 60, "abc deT  \n.,!?é日0123 '", 80) + ["été naïve, déjà! x² it's. ªb cd?! ,", "same words here."] * 40
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    monkeypatch.setattr(byte_bpe, "_CODES", 20)
    bundles = list(byte_bpe._bundles(ranks, set(), PATTERN)(iter([batch])))
    sent = [w["s"] for b in bundles for w in b.column("words")[0].as_py()]
    assert len(bundles) > 10 and len(sent) == len(set(sent))
    assert [b.column("forgotten")[0].as_py() for b in bundles] == [True] + [False] * (len(bundles) - 1)
    monkeypatch.setattr(byte_bpe, "_KNOWN", 60)
    bundles = list(byte_bpe._bundles(ranks, set(), PATTERN)(iter([batch])))
    assert 2 < sum(b.column("forgotten")[0].as_py() for b in bundles) < len(bundles)
    got = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in byte_bpe_encode(documents(list(enumerate(texts))).coalesce(1), RANKS, PATTERN).collect()}
    assert got == {i: (lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)}


def test_letters_and_marks_are_split_as_by_the_pattern(documents):
    texts = ["a", "a.", " a,", "é!? b", "a..", ".a", "a.b", "日本. ٣.", "ǅ! ʰ, ª. x̂.", "   a.", "a. \n b", "　a, \x1ca."]
    other = PATTERN + "|$"  # the same words, found by a search
    want = library(RANKS)
    for pattern in (PATTERN, other):
        got = {r.doc_id: list(r.ids) for r in byte_bpe_encode(documents(list(enumerate(texts))), RANKS, pattern).collect()}
        assert got == {i: want.encode_ordinary(t) for i, t in enumerate(texts)}
