import random

import corpus_pipeline
from wardgrid.llm import langid

SYLLABLES = {"aa": "ka to mi ne ru".split(), "bb": "sch ung ver ß ü".split()}


def prose(source, lang, n):
    return " ".join("".join(source.choices(SYLLABLES[lang], k=5)) + str(source.randrange(10**6)) for _ in range(n))


def test_each_stage_takes_effect(spark, tables, model_path):
    import sentencepiece

    source = random.Random(3)
    clean = [(k, prose(source, lang, 60), lang) for k, lang in enumerate(["aa", "bb"] * 20)]
    passage = prose(source, "aa", 55)
    item = prose(source, "bb", 20)
    near = clean[4][1].split()
    near[30] = "edited"
    odd = [
        (100, None, "aa"),
        (101, "12345 ...", "aa"),
        (102, f"{prose(source, 'aa', 40)}\n{passage}", "aa"),
        (103, f"{prose(source, 'aa', 40)}\n{passage}\nend", "aa"),
        (104, clean[0][1], "aa"),
        (105, " ".join(near), "aa"),
        (106, f"{prose(source, 'bb', 30)} {item} {prose(source, 'bb', 30)}", "bb"),
    ]
    rows = [(d, x, lang, "s", len(x or "")) for d, x, lang in clean + odd]
    path = tables(documents=rows, benchmark=[(1, item)])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r for r in docs.collect()})
    everything = {d for d, _, _ in clean}
    assert set(kept[0]) == everything | {102, 103, 104, 105, 106}
    assert set(kept[1]) == everything | {102, 103, 105, 106}
    assert kept[1][103].text.count("\n") == 1 and kept[1][103].n_chars == len(kept[1][103].text) and passage in kept[1][102].text
    assert set(kept[2]) == everything | {102, 103, 106}
    assert set(kept[3]) == everything | {102, 103}
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    done = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(done) == set(kept[3])
    assert all(list(r.ids) == library.encode(kept[3][d].text, add_bos=True, add_eos=True) and r.n_tokens == len(r.ids) for d, r in done.items())


def test_empty_documents(spark, tables):
    assert corpus_pipeline.run(spark, tables()).count() == 0
    assert langid.UNKNOWN == "und" and corpus_pipeline.ORACLE_SQL is None
