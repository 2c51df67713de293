"""Operators 6 and 7 against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from tallyload.llm.bpe import Encoder, bpe_digests, bpe_encode, encode_long, encode_short, read_vocabulary
from tallyload.llm.queries import vocabulary_path
from tallyload.llm.token_counts import attribute, token_counts

tokenizers = pytest.importorskip("tokenizers")

EDGES = ["", " ", "  ", "a  b", "a \n b", "\n\n x", "it's  we'll '", "x<|endoftext|> y<|endoftext|>", "é z  q", "\x1c a\x1d", "日本語 テスト 123abc",
         "ab" * 3000 + " ", "\t\t hello\t\tworld \r\n", " lead", "😀 😀😀", "  <|endoftext|>  tail  ", "'S I'VE don't", " \x85 x", "​ ​x", "áb",
         "x" * 33 + " " + "y" * 32, "one\ntwo\n\nthree", "end \n \n start", "\x00\x01"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read_vocabulary(vocabulary_path()))


def noise(seed, n):
    rng = random.Random(seed)
    alphabet = "abc deT  \n\t.,'!?é日😀0123456789 |<>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_ids_and_decoding_equal_the_library(library, encoder):
    for text in EDGES + noise(1, 400):
        ids = library.encode(text, add_special_tokens=False).ids
        got = encoder.encode([text])[0]
        assert np.frombuffer(got, "<u4").tolist() == ids, repr(text)
        assert encoder.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_segment_trees_agree(encoder):
    rng = random.Random(2)
    tokens = [bytes(rng.choice(b"the andinge") for _ in range(rng.randint(2, 16))) for _ in range(500)]
    short = encode_short(tokens, 16, encoder.v)
    assert [np.frombuffer(x, "<u4").tolist() for x in short] == [encode_long(t, encoder.v) for t in tokens]


def test_small_cache_gives_equal_ids():
    texts = noise(3, 100)
    small = Encoder(read_vocabulary(vocabulary_path()), max_cached=5)
    assert [small.encode([t])[0] for t in texts] == Encoder(read_vocabulary(vocabulary_path())).encode(texts)


def test_encode_table(documents, library):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(None, "x y"), (3, "a  b"), (900, None), (901, "word " * 50_000)]
    got = bpe_encode(documents(rows), vocabulary_path()).collect()
    assert len(got) == len(rows)
    want = sorted((-1 if i is None else i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids), r.decoded) for r in got) == want
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_digests(documents(rows), vocabulary_path()).collect()}
    assert digests == {(r.doc_id, len(r.ids), hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(r.decoded.encode()).hexdigest()) for r in got}
    assert bpe_encode(documents([]), vocabulary_path()).collect() == []


def brute_sections(library, sections, rule):
    text = "".join(sections)
    starts, at = [], 0
    for s in sections:
        starts.append(at)
        at += len(s)
    counts, crossing = [0] * len(sections), 0
    enc = library.encode(text, add_special_tokens=False)
    for a, b in enc.offsets:
        held = [max(0, min(b, st + len(s)) - max(a, st)) for st, s in zip(starts, sections)]
        inside = [i for i, h in enumerate(held) if h]
        crossing += len(inside) > 1
        counts[{"first": inside[0], "last": inside[-1], "most": max(inside, key=lambda i: (held[i], -i))}[rule]] += 1
    return len(enc.ids), crossing, counts


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_counts_by_line(documents, library, rule):
    texts = ["one\ntwo\n\n\nthree", "a\n\n\n\nb  \n  c", "\n", "plain", "x\n" * 300, "tail\n\n"]  # ASCII: characters are bytes
    rows = list(enumerate(texts)) + [(50, None), (51, ""), (None, "a\nb"), (0, texts[0])]
    got = token_counts(documents(rows), vocabulary_path(), rule=rule).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(texts):
        n, crossing, counts = brute_sections(library, t.splitlines(keepends=True), rule)
        assert (by_id[i].n_tokens, by_id[i].n_crossing, by_id[i].section_tokens) == (n, crossing, counts)
    assert [(by_id[i].n_tokens, by_id[i].section_tokens) for i in (50, 51)] == [(0, [])] * 2
    assert token_counts(documents([]), vocabulary_path()).collect() == []


def test_counts_by_field(documents):
    rows = [(1, "some words here", "en", "web"), (2, None, None, "x"), (3, "日本語", "ja", None)]
    got = {r.doc_id: r for r in token_counts(documents(rows), vocabulary_path(), fields=["lang", "text", "source"], rule="first").collect()}
    assert all(len(r.section_tokens) == 3 and sum(r.section_tokens) == r.n_tokens for r in got.values())
    assert got[2].section_tokens[:2] == [0, 0] and got[3].section_tokens[2] == 0
    with pytest.raises(ValueError):
        token_counts(documents(rows), vocabulary_path(), rule="other")


def test_attribute_splits_by_rule():
    lengths, starts = np.array([3, 4, 2]), np.array([0, 4])  # the second token has 1 byte before the border and 3 after it
    assert attribute(lengths, starts, "first")[0].tolist() == [2, 1]
    assert attribute(lengths, starts, "last")[0].tolist() == [1, 2]
    assert attribute(lengths, starts, "most") [0].tolist() == [1, 2]
    assert attribute(np.array([2, 4]), np.array([0, 4]), "most")[0].tolist() == [2, 0]  # a tie goes to the earlier section
    assert attribute(np.zeros(0, np.int64), np.array([0]), "most")[0].tolist() == [0]
