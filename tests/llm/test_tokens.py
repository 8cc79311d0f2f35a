"""Token counts and SentencePiece coding against the libraries themselves."""

import hashlib
import random

import pytest

from tests.llm.helpers import bag, empty_docs, hard_docs

P = pytest.importorskip("public_tokenizers")

from landlens.llm import sentencepiece_bpe, token_count  # noqa: E402

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
STRANGE = ["a", "b", " ", "  ", "\n", "\t", "é", "漢", "1", ",", "'", "<|endoftext|>", "it's", "​", "᠎", "\x85", "　", "▁", "<s>", "<0x41>", "①", "😀", "\x00",
           "the", "in", "ing", "er", "a" * 40, "    ", "▁▁"]


def strange_texts(n, seed=11):
    rng = random.Random(seed)
    return ["".join(rng.choice(STRANGE) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def library_counts(texts):
    t = token_count._tokenizer(BYTE)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    docs, rows = hard_docs(spark)
    out = token_count.count_tokens(docs, BYTE).collect()
    counts = library_counts([t or "" for _, t in rows])
    want = [(i, len((t or "").encode()), c, c > 512) for (i, t), c in zip(rows, counts)]
    assert bag(tuple(r) for r in out) == bag(want)
    assert token_count.count_tokens(empty_docs(spark), BYTE).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(16, 4), (100, 8), (1000, 64)])
def test_resynchronisation_is_exact(chunk, overlap):
    texts = strange_texts(1500) + ["ab " * 700, "x" * 3000, " " * 500, "a\n" * 900]
    starts = token_count.encode_spans(BYTE)
    assert [token_count.resync_count(t, starts, chunk, overlap) for t in texts] == library_counts(texts)


def test_pieces_are_cut_at_proven_places():
    texts = strange_texts(3000, 12)
    assert token_count.Counter(BYTE, remembered=200).count(texts) == library_counts(texts)


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    docs, rows = hard_docs(spark)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = sp.encode(t or "") + [sp.eos_id()]
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    out = sentencepiece_bpe.encode_decode(docs, PIECE, digests=True).collect()
    assert bag(tuple(r) for r in out) == bag(want)
    full = {r.doc_id: r for r in sentencepiece_bpe.encode_decode(docs, PIECE, add_end=False).collect()}
    assert full[5].ids == sp.encode(dict(rows)[5]) and full[5].decoded == dict(rows)[5]
    assert sentencepiece_bpe.encode_decode(empty_docs(spark), PIECE).count() == 0


def test_backtracking_equals_the_library_and_merging():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model, coder = sentencepiece_bpe.load(PIECE), sentencepiece_bpe.Coder(PIECE, remembered=50)
    for t in strange_texts(4000, 13):
        ids = sp.encode(t)
        assert model.encode(t) == ids, t
        assert model.decode(ids) == sp.decode(ids), t
        assert coder.code(t)[1:] == (" ".join(map(str, ids)), sp.decode(ids)), t
    for s in sentencepiece_bpe.segments("antidisestablishmentarianism  internationalisation"):
        assert model.split(s) == model.merge(s)


def test_invalid_bytes_decode_like_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model = sentencepiece_bpe.load(PIECE)
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.choice([3 + 0xE2, 3 + 0x91, 3 + 0xA0, 3 + 0xFF, 272, 262, 259, 2, 1]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == sp.decode(ids), ids
