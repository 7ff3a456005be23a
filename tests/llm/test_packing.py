import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from tillage.llm.packing import WordEncoder, best_two_fit, encoder, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("text", ["It's we'll O'Neil--'s 12½ ÀÉß œuvre a\tb\xa0c", "<|endoftext|> x", "ſ ΑΣ İ ́e", "", "x" * 5000, "don't!!! ''' 's"])
def test_word_ids_are_the_tokenizers(text):
    e = encoder(PATH)
    assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_bins_hold_all_pieces_and_fit():
    rng = np.random.default_rng(4)
    counts = np.zeros(101, np.int64)
    for n in rng.integers(1, 101, 3000):
        counts[n] += 1
    fills = best_two_fit(counts.copy(), 100)
    total = np.zeros_like(counts)
    bins = 0
    for used, many in fills:
        assert sum(n * c for n, c in used) <= 100
        bins += many
        for n, c in used:
            total[n] += c * many
    assert (total == counts).all()
    assert bins <= 1.02 * (counts * np.arange(101)).sum() / 100 + 1


def one_bin_at_a_time(lengths, size):
    """The same rule on a plain list of pieces, a bin after the other: sorted contents of the bins."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_ = [left.pop(0)]
        while fitting := [n for n in left if n <= size - sum(bin_)]:
            bin_.append(fitting[0])
            left.remove(fitting[0])
        while (gap := size - sum(bin_)) and len(bin_) > 1:
            small = min(bin_)
            pairs = [(a + b, -a) for i, a in enumerate(left) for j, b in enumerate(left) if i != j and small < a + b <= gap + small]
            if not pairs:
                break
            total, a = max(pairs)
            bin_.remove(small)
            bin_ += [-a, total + a]
            left.remove(-a)
            left.remove(total + a)
            left = sorted([*left, small], reverse=True)
        bins.append(sorted(bin_))
    return sorted(bins)


def test_fillings_equal_one_bin_at_a_time():
    """Fillings repeated by counts give the bins of a pass over single pieces."""
    rng = np.random.default_rng(22)
    for size, n, high in ((30, 60, 31), (50, 120, 20), (20, 100, 21), (64, 80, 65), (12, 90, 6)):
        for _ in range(4):
            lengths = rng.integers(1, high, n).tolist()
            fills = best_two_fit(np.bincount(lengths, minlength=size + 1), size)
            got = sorted(sorted(k for k, c in used for _ in range(c)) for used, many in fills for _ in range(many))
            assert got == one_bin_at_a_time(lengths, size)


def test_two_smaller_pieces_replace_one():
    counts = np.zeros(11, np.int64)
    counts[[7, 2, 1]] = [1, 1, 1]
    assert len(best_two_fit(counts, 10)) == 1
    counts = np.zeros(101, np.int64)
    counts[[60, 35, 25, 15]] = [1, 1, 1, 1]
    assert best_two_fit(counts, 100)[0][0] == ((60, 1), (25, 1), (15, 1))


def test_documents_come_back_whole(spark):
    docs = [(i, " ".join(f"w{j}" for j in range(i * 7))) for i in range(60)] + [(100, None), (101, "long " * 9000)]
    got = pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), PATH, size=512).toPandas()
    e = encoder(PATH)
    for doc, text in docs:
        ids = e.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        parts = got[got.doc_id == doc].sort_values("piece")
        assert parts.length.sum() == len(ids) and parts.start.tolist() == (parts.length.cumsum() - parts.length).tolist()
        assert (parts.length.iloc[:-1] == 512).all()
        for r in parts.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    ordered = got.sort_values(["sequence_id", "offset"])
    used = ordered.groupby("sequence_id").length
    assert (used.cumsum() - ordered.length == ordered.offset).all() and used.sum().max() <= 512
    assert got.sequence_id.nunique() <= np.ceil(got.length.sum() / 512) + 1


def test_awkward_rows(awkward):
    got = pack_documents(awkward, PATH).toPandas()
    assert len(got[got.piece == 0]) == 9 and (got.length >= 1).all()
    assert pack_documents(awkward.limit(0), PATH).count() == 0
    assert isinstance(got, pd.DataFrame)


def test_new_words_go_through_the_tokenizer_together():
    """Ids of words of every kind equal those of each alone, in few calls' texts; a tokenizer without word ends gives the same."""
    rng = np.random.default_rng(31)
    letters = list("abcxyz019'.,!-\"éßø½²ªœ~")
    words = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(5000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    want = [encoder(PATH).tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for ends in (True, False):
        e = WordEncoder(PATH)
        e.last &= ends
        given, inner = [], e.tokenizer

        class Counted:
            def encode_batch_fast(self, batch, **more):
                given.extend(batch)
                return inner.encode_batch_fast(batch, **more)

        e.tokenizer = Counted()
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == want
        assert not ends or len(given) <= len(e.words) / 100
