import random

import pytest

from wardgrid.llm import linededup, queries


def brute(rows, least):
    """All later occurrences of every run with enough words."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    seqs = {r: [(k, x) for k, x in enumerate(r[1].split("\n")) if x.strip(" ")] for r in docs}
    seen, gone = set(), {}
    for r in docs:
        seq = seqs[r]
        for a in range(len(seq)):
            words = 0
            for b in range(a, len(seq)):
                words += seq[b][1].count(" ") + 1
                run = tuple(x for _, x in seq[a : b + 1])
                if words >= least:
                    if run in seen:
                        gone.setdefault(r, set()).update(k for k, _ in seq[a : b + 1])
                    seen.add(run)
    return {r: gone.get(r, set()) for r in docs}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    source = random.Random(seed)
    lines = [" ".join("w" for _ in range(source.randint(1, 6))) + f" {k}" for k in range(25)]
    runs = [[source.choice(lines) for _ in range(source.randint(2, 7))] for _ in range(8)]
    rows = []
    for k in range(40):
        parts = [x for _ in range(source.randint(0, 4)) for x in source.choice([[source.choice(lines)], source.choice(runs), ["", " "], [f"own {source.random()}"]])]
        rows.append((k, "\n".join(parts)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (3, rows[3][1]), (60, rows[5][1])]
    found = linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 9).collect()
    expected = brute(rows, 9)
    assert len(found) == len(rows)
    for r in found:
        gone = expected.get((r.doc_id, r.text), set())
        spans = [tuple(map(int, x.split("-"))) for x in r.deleted.split(",") if x]
        assert {k for a, b in spans for k in range(a, b + 1)} == gone
        assert r.n_deleted == len(gone) and all(a > d + 1 for (_, d), (a, _) in zip(spans, spans[1:], strict=False))
        if r.text is None:
            assert r.kept_text is None and r.n_lines == 0
        else:
            assert r.kept_text == "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone)


def test_passages_copies_and_clean_documents(spark, tables):
    source = random.Random(7)
    prose = lambda n: " ".join(f"w{source.randrange(10**6)}" for _ in range(n))
    passage = f"{prose(30)}\n{prose(25)}"
    rows = [(k, f"{prose(40)}\n{passage}\n{prose(20)}") for k in range(5)] + [(9, prose(400)), (10, "\n".join(prose(9) for _ in range(3000)))]
    rows += [(11, rows[0][1]), (12, "short line"), (13, "short line"), (None, passage)]
    found = {r.doc_id: r for r in queries.op1_line_dedup(spark, tables(documents=rows)).collect()}
    assert [found[k].deleted for k in range(5)] == ["", *["1-2"] * 4]
    assert all(found[k].n_deleted == 0 and found[k].text == dict(rows)[k] for k in (9, 10, 12, 13))
    assert found[11].text == "" and found[11].deleted == "0-3" and found[None].deleted == "0-1"
    assert queries.op1_line_dedup(spark, tables()).count() == 0


def counted(line):
    """Words of a line, character by character."""
    words, inside = 0, False
    for c in line:
        lone = "\u3041" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff"
        words += lone or (not c.isspace() and not inside)
        inside = not c.isspace() and not lone
    return words


def test_words_of_code_tables_and_chinese(spark, tables):
    source = random.Random(11)
    han = lambda n: "".join(chr(source.randrange(0x4E00, 0x9F00)) for _ in range(n))
    shared = [" " * 12 + "}", " " * 40 + "return x", "\r", "\t", "\u3000\xa0", "a\tb\tc", "\t".join("abcdefghijklm"), han(12), han(13), han(6) + " ab  cd " + han(4), "x" * 300, "\u30c6\u30b9\u30c8" * 5, "if x:\r"]
    rows = [(k, "\n".join(x for _ in range(9) for x in (source.choice(shared), *[f"own {source.random()}"] * (source.random() < 0.6)))) for k in range(60)]
    docs = {}
    for k, text in rows:
        docs[k] = [(n, x) for n, x in enumerate(text.split("\n")) if x.strip()]
    seen, gone = set(), {k: set() for k in docs}
    for k, seq in docs.items():
        for a in range(len(seq)):
            for b in range(a, len(seq)):
                run = tuple(x for _, x in seq[a : b + 1])
                if sum(map(counted, run)) >= linededup.MIN_WORDS:
                    if run in seen:
                        gone[k].update(n for n, _ in seq[a : b + 1])
                    seen.add(run)
    found = {r.doc_id: r for r in queries.op1_line_dedup(spark, tables(documents=rows)).collect()}
    for k, text in rows:
        assert found[k].text == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[k])
    code = [(k, "\n".join(f"{f}{k}" for f in ("def f", "g = ")) + "\n" + " " * 16 + "}") for k in range(3)]
    assert all(r.n_deleted == 0 for r in queries.op1_line_dedup(spark, tables(documents=code)).collect())
    lone = [r.n_deleted for r in queries.op1_line_dedup(spark, tables(documents=[(k, shared[8]) for k in range(3)])).collect()]
    assert sorted(lone) == [0, 1, 1]


def test_words_are_counted_up_to_what_a_run_needs(spark):
    from pyspark.sql import functions as F

    pieces = ["a", "é", " ", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u3000", "漢", "ひ", "カ", "ㄅ", "\u02ea", "Ж", "한", "🙂", "-", "."]
    source = random.Random(3)
    lines = ["".join(source.choice(pieces[: source.choice([8, 21])]) for _ in range(source.randint(0, 30))) for _ in range(1500)]
    frame = spark.createDataFrame([(x,) for x in lines], "x string")
    for enough in (1, 4, 13):
        wrong = linededup.words_in(F.col("x"), enough) != F.least(F.regexp_count("x", F.lit(linededup.WORD)), F.lit(enough))
        assert frame.filter(wrong).collect() == []


def test_a_long_text_is_rebuilt_in_one_pass(spark):
    kept = [f"own line {k}" for k in range(100_000)]
    shared = "one line of many words that is in both documents and so goes from one of them"
    rows = [(1, shared), (2, "\n".join(x for k in kept for x in (k, shared)))]
    found = {r.doc_id: r for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2].n_deleted == 100_000 and found[2].kept_text == "\n".join(kept)
    assert found[2].deleted.startswith("1-1,3-3,5-5") and found[2].n_lines == 200_000
