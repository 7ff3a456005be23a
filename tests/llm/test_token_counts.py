import numpy as np
import public_tokenizers
import pytest

from tillage.llm.token_counts import attribute, encoding, line_sections, section_tokens

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("rule", ["most", "first", "last"])
def test_attribute_equals_brute_force(rule):
    rng = np.random.default_rng(9)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 5, 12))
        cut = np.sort(rng.choice(np.arange(0, ends[-1] + 1), 6, replace=False))
        sections = np.array([(cut[0], cut[1]), (cut[1], cut[1]), (cut[2], cut[3]), (cut[3], cut[5])])
        want = [0] * 4
        begin = 0
        for end in ends:
            part = [max(0, min(end, b) - max(begin, a)) for a, b in sections]
            if any(part):
                some = [i for i, n in enumerate(part) if n]
                want[{"first": some[0], "last": some[-1], "most": int(np.argmax(part))}[rule]] += 1
            begin = end
        assert attribute(ends, sections, rule).tolist() == want


def test_sections_add_up_and_tile(spark):
    texts = ["one\ntwo  \n\n three", "\n", "", "ñandú €\U0001f600\nx", "no end", "a\n" * 300]
    got = section_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, PATTERN).toPandas()
    enc, _ = encoding(PATH, PATTERN)
    for i, t in enumerate(texts):
        part = got[got.doc_id == i].sort_values("section")
        assert part.n_tokens.sum() == len(enc.encode_ordinary(t)) == part.doc_tokens.iloc[0]
        assert part.n_chars.sum() == len(t)
        assert part.n_chars.tolist() == [len(x) for x in t.splitlines(keepends=True)] or not t


def test_given_sections(spark):
    docs = spark.createDataFrame([(1, "ñé one two", [(0, 2), (3, 6)]), (2, "x", None), (3, None, [(0, 5)])], "doc_id long, text string, s array<struct<start:int,end:int>>")
    got = {(r.doc_id, r.section): (r.n_chars, r.n_tokens) for r in section_tokens(docs, PATH, PATTERN, sections="s").collect()}
    assert set(got) == {(1, 0), (1, 1), (3, 0)} and got[1, 1] == (3, 1) and got[3, 0][1] == 0


def test_lines():
    assert line_sections(b"a\nb").tolist() == [[0, 2], [2, 3]] and line_sections(b"a\n").tolist() == [[0, 2]] and line_sections(b"").tolist() == [[0, 0]]


def test_awkward_rows(awkward):
    got = section_tokens(awkward, PATH, PATTERN).toPandas()
    assert got.groupby("doc_id", dropna=False).section.min().tolist() == [0] * 7
    assert got[got.doc_id == 2].n_tokens.tolist() == [0]
    assert section_tokens(awkward.limit(0), PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        section_tokens(awkward, PATH, PATTERN, rule="half")
