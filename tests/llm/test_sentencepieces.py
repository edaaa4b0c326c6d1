import hashlib
import random

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from wardgrid.llm import queries, sentencepieces

TEXTS = [
    None,
    "",
    " ",
    "  two  blanks and a mark ▁ at  ",
    "line\n\ntab\t\x00 null <s> </s> <unk> <0x0A>",
    "emoji 🙂 中文 é é 　 ﬁ",
    "word " * 5000,
    "x" * 20000,
    "a�b",
]


def test_ids_and_decoding_equal_the_library(spark, tables, model_path):
    path = tables(documents=[(k, x) for k, x in enumerate(TEXTS)] + [(3, TEXTS[3])])
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = queries.op3_sentencepiece(spark, path).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        ids = library.encode(TEXTS[row.doc_id] or "", add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_texts_and_random_ids(model_path):
    model = sentencepieces.pieces(model_path)
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    source, entries = random.Random(5), list(model.ids)
    for _ in range(1500):
        text = "".join(source.choice(entries)[: source.randint(1, 9)] for _ in range(source.randint(0, 12)))
        ids = np.frombuffer(model.encode(text), "<u4")
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
        loose = np.array([source.choice([source.randrange(32000), source.randrange(3, 259)]) for _ in range(9)])
        assert model.decode(loose) == library.decode(loose.tolist())


def test_columns_pass_through_and_clashing_names_are_replaced(spark, model_path):
    rows = spark.createDataFrame([(1, "one", "x", 7), (1, "one", "x", 7)], "doc_id long, text string, ids string, more int")
    found = sentencepieces.encode(rows, model_path)
    assert found.columns == ["doc_id", "text", "more", "ids", "decoded"]
    assert [r.decoded for r in found.collect()] == ["one", "one"]
    assert sentencepieces.encode(rows.filter(F.lit(False)), model_path).count() == 0
