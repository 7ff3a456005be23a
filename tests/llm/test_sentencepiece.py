import numpy as np
import public_tokenizers
import pytest

from tillage.llm.sentencepiece_nbest import SPACE, encode_nbest, model, nbest_digest

PATH = public_tokenizers.path("piece_bpe_32k.model")


def slow(pieces, text):
    """Scores and ids of all segmentations."""
    if not text:
        return [(0.0, [])]
    out = []
    for n in range(1, len(text) + 1):
        head = text[:n]
        found = pieces.pieces.get(head)
        if found:
            first = (found[1], [found[0]])
        elif n == 1:
            first = (pieces.worst, [pieces.byte[b] for b in head.encode()])
        else:
            continue
        out += [(first[0] + s, first[1] + i) for s, i in slow(pieces, text[n:])]
    return out


@pytest.mark.parametrize("text", ["the one", "a  b", "ñx€", "\n\nab", "in the", "\U0001f600a"])
def test_nbest_equals_all_segmentations(text):
    pieces = model(PATH)
    every = sorted((-s for s, _ in slow(pieces, SPACE + text.replace(" ", SPACE))))[:8]
    got = next(pieces.encode_all([text], 8))
    assert [-s for s, _ in got] == pytest.approx(every)
    assert len({i for _, i in got}) == len(got)
    assert next(pieces.encode_all([text], 1))[0][0] == got[0][0]
    assert all(pieces.decode(i) == text for _, i in got)


def test_second_best_loss():
    pieces = model(PATH)
    units = ["▁thing", "▁international", "▁x", "ßtraße", "漢字x"]
    pieces.forget()
    pieces.learn(units)
    learnt = {u: (np.concatenate(pieces.scores)[k], np.concatenate(pieces.losses)[k], pieces.blobs[k]) for u, k in pieces.units.items()}
    pieces.forget()
    for unit in units:
        n = pieces.nbest(unit, 2)
        score, loss, ids = learnt[unit]
        assert score == pytest.approx(n[0][0]) and (loss == pytest.approx(n[0][0] - n[1][0]) if len(n) > 1 else loss > 1e200)
        assert pieces.decode(ids) == pieces.decode(n[0][1])
        assert pieces.first(unit)[2] == pytest.approx(n[0][0] - n[1][0]) if len(n) > 1 else pieces.first(unit)[2] > 1e200


def test_round_trip(spark):
    texts = ["Straße naïve\tx\r\n  y ", "", "漢字 mixed \x00 end", "a" * 3000]
    rows = nbest_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, 3).collect()
    assert all(r.exact for r in rows) and {r["rank"] for r in rows if r.doc_id == 0} == {1, 2, 3}


def test_awkward_rows(awkward):
    rows = encode_nbest(awkward, PATH, 2).collect()
    assert len([r for r in rows if r["rank"] == 1]) == 9
    assert [(r.score, list(r.ids)) for r in rows if r.doc_id == 2] == [(0.0, [])]
    assert encode_nbest(awkward.limit(0), PATH).count() == 0
    assert np.isfinite([r.score for r in rows]).all()


def test_one_long_unbroken_run():
    """Long runs go through the lattice alone, ties and all, in time that grows with their length."""
    pieces = model(PATH)
    for text in ("a" * 100_000, "xqz" * 40_000):
        got = next(pieces.encode_all([text], 3))
        assert len(got) >= 2 and all(pieces.decode(i) == text for _, i in got) and [x for x, _ in got] == sorted((x for x, _ in got), reverse=True)
