import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_line_dedup import slow_dedup
from tests.llm.test_simhash import slow_fingerprint, slow_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: three languages, toxic documents, copies, shared lines, a text without letters, null."""
    rng = np.random.default_rng(20)
    roots = {"en": ["th", "ing", "er", "wh", "ou", "sh"], "de": ["sch", "ei", "ung", "ö", "pf", "zu"], "fr": ["eau", "ç", "oi", "ez", "qu", "è"]}
    docs, labels = [], []
    for i in range(300):
        lang = ["en", "de", "fr"][i % 3]
        lines = [" ".join("".join(rng.choice(roots[lang], rng.integers(1, 4))) for _ in range(30)) for _ in range(3)]
        toxic = i % 4 == 1
        if toxic:
            lines[1] += " vileword"
        docs.append((i, "\n".join(lines), lang, f"src{i % 5}"))
        labels.append((i, int(toxic), 1))
    docs.append((300, docs[0][1], "en", "src0"))
    docs.append((301, docs[2][1].replace(" ", "  ", 1) + "\n" + docs[3][1].split("\n")[0], "fr", "src1"))
    docs += [(302, "123 ... !!!", "en", "src1"), (303, None, "en", "src1"), (304, "", "de", "src2")]
    d = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{d}/labels.parquet")
    return str(d), docs


def test_stages_against_brute_force(spark, folder):
    d, docs = folder
    frame = spark.read.parquet(f"{d}/documents.parquet")
    columns = frame.columns
    texts = {i: t for i, t, _, _ in docs}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stage(spark, frame, d)
        if name != "packing":
            assert frame.columns == columns
        frame = frame.cache()
        kept[name] = {r.doc_id: r.text for r in frame.collect()} if name != "packing" else frame.toPandas()
        if name == "language_id":
            assert set(kept[name]) == set(texts) - {302, 303, 304}
        if name == "toxicity":
            assert set(kept[name]) == {i for i in kept["language_id"] if "vileword" not in texts[i]}
        if name == "line_dedup":
            want = {i: t for i, t in slow_dedup(sorted(kept["toxicity"].items())).items() if t.strip()}
            assert kept[name] == want and 300 not in want
            assert all(r.n_chars == len(r.text) for r in frame.select("n_chars", "text").collect())
        if name == "simhash_dedup":
            groups = slow_groups([(i, slow_fingerprint(t)) for i, t in kept["line_dedup"].items()])
            assert set(kept[name]) == set(groups.values())
        del before
    packed = kept["packing"]
    assert set(packed.doc_id) == set(kept["simhash_dedup"]) and packed.groupby("sequence_id").length.sum().max() <= 4096
    run = corpus_pipeline.run(spark, d).toPandas()
    assert sorted(run.ids_crc32) == sorted(packed.ids_crc32)


def test_one_doc_id_with_several_texts(spark):
    rng = np.random.default_rng(21)
    a, b, c, d = (" ".join(rng.choice([f"w{i}" for i in range(500)], 80)) for _ in range(4))
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, b, "x"), (3, a, "x"), (4, c, "x"), (5, a, "x"), (5, d, "x"), (None, a, "x"), (None, a, "x")]
    got = corpus_pipeline.dedup_documents(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, a), (0, a), (1, a), (1, b), (4, c), (5, d)])


def test_awkward_documents(spark, folder, awkward):
    d, _ = folder
    frame = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, d)
        assert out.columns == frame.columns, name
        assert out.count() <= frame.count() and stage(spark, frame.limit(0), d).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, awkward, d).count() >= 9
