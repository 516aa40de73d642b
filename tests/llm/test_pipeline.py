"""The pipeline on a small corpus with planted cases."""

import random

import sentencepiece

import corpus_pipeline
from barloom.llm.queries import MODEL


def write(spark, root, docs, labels, items):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")


def corpus():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("ba ke lo ti ru sa no mi".split()) for _ in range(rnd.randint(2, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    docs = {k: prose(120) + "\n" + prose(60) for k in range(80)}
    labels = []
    for k in range(80, 110):
        docs[k] = prose(60) + " you moron " + prose(40) + " scum"
    for k in range(110):
        if k % 3:
            labels.append((k, 1, int(k >= 80)))
    item = prose(30)
    docs[200] = docs[1]                                         # a copy
    docs[201] = prose(150) + "\n" + item + "\n" + prose(80)     # a benchmark passage
    docs[202] = prose(100) + "\n" + docs[2].split("\n")[1]      # a passage of another document
    docs[203], docs[204], docs[205] = None, "", " \n "
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in docs.items()]
    return rows + [rows[5], (None, prose(50), None, None, None)], labels, [(1, item), (2, None), (3, "")]


def test_run(spark, root):
    docs, labels, items = corpus()
    write(spark, root, docs, labels, items)
    out = corpus_pipeline.run(spark, root).collect()
    # What lines or copies have left empty is one group, of which one stays: the repeated row here.
    assert [r.doc_id for r in out if not r.text] == [5]
    out = [r for r in out if r.text]
    kept = {r.doc_id: r for r in out}
    texts = {d[0]: d[1] for d in docs}
    assert not set(range(80, 110)) & set(kept)                  # toxic ones are gone
    assert set(range(80)) <= set(kept)                          # clean ones stay
    assert 201 not in kept                                      # contaminated
    assert kept[202].text == texts[202].split("\n")[0]          # without the repeated line
    assert kept[202].n_chars == len(kept[202].text)
    assert None in kept and len(out) == len(kept)               # the repeated row stays once
    assert not {200, 203, 204, 205} & set(kept)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in out:
        assert r.ids == library.encode(r.text or "", add_bos=True, add_eos=True)


def test_stages_keep_columns_and_take_empty_tables(spark, root):
    docs, labels, items = corpus()
    write(spark, root, docs, labels, items)
    table = spark.read.parquet(f"{root}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash", "decontamination", "sentencepiece"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, table.where("false"), root)
        assert got.count() == 0
        assert k == 4 or got.columns == table.columns
