from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsgraph.llm import line_rules

WS = " \t\n\x0b\x0c\r"


def brute(text):
    ws = [w for w in "".join(" " if c in WS else c for c in text or "").split(" ") if w]
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(WS)]
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(repeated))


def test_counts_equal_brute_force(docs, odd_docs):
    for table in (docs, odd_docs):
        got = line_rules.judge(table.select("doc_id", "text")).select("text", *line_rules.COUNTS).collect()
        assert len(got) == table.count()
        for r in got:
            assert tuple(r)[1:] == brute(r["text"])


@pytest.mark.parametrize("line, fails", [
    ("A plain sentence about the weather in the north.", False),
    ("Home | News | Sport | Contact", True),
    ("to%%% the&&& onor*** rend###", True),
    ("BUY!! NOW!! AND!! SAVE!! MUCH!!", True),
    ("word " * 40, True),
    ("We use a Cookie Policy for this site.", True),
    ("Either a | b is fine, as is x > y.", False),
])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert (df.select(line_rules.line_left(F.col("line"))).first()[0] == "") is fails


def test_clean_text_and_loss(spark):
    good = "\n".join(" ".join(f"word{i}x{k}" for k in range(9)) + "." for i in range(9))
    junk = "\n".join(f"a{i} | b{i} | c{i} | d{i} | e{i}" for i in range(60))
    df = spark.createDataFrame([(1, good), (2, good + "\nHome | News | Sport | Contact"), (3, good + "\n" + junk)],
                               "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_rules.judge(df).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, True, False]
    assert got[2]["clean_text"] == good


def test_keeps_good_and_drops_bad_labels(docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = line_rules.judge(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count()
    assert {(r["quality"], r["kept"]) for r in got.collect()} <= {(0, False), (1, True)}


def test_empty_table_and_clashing_columns(odd_docs, no_docs):
    assert line_rules.op6(no_docs).collect() == []
    assert line_rules.op6(odd_docs).count() == odd_docs.count()
    assert line_rules.clean(odd_docs).columns == odd_docs.columns


def test_a_notice_in_a_long_line_does_not_cost_the_document(spark):
    long, more = (" ".join(f"Sentence {i} tells of item{i} and place{i}." for i in range(a, a + 300)) for a in (0, 300))
    rows = [(1, long + " They signed a privacy policy in May. " + more),
            (2, "All rights reserved to " + " ".join(f"owner{i}" for i in range(80)) + "."), (3, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in line_rules.clean(df).collect()) == [1, 3]
    assert {r["doc_id"]: r["kept"] for r in line_rules.op6(df).collect()} == {1: True, 2: False, 3: True}
    got = {r["doc_id"]: r for r in line_rules.judge(df).collect()}
    assert got[1]["lost_chars"] == len("TheysignedaprivacypolicyinMay.") and "policy" not in got[1]["clean_text"]
    assert got[2]["clean_text"] == "" and got[3]["lost_chars"] == 0 and got[3]["clean_text"] == long


def test_clean_gives_the_text_that_is_left(spark):
    good = "\n".join(" ".join(f"word{i}x{k}" for k in range(9)) + "." for i in range(9))
    rows = [(1, good.replace(".\n", ".\n\n"), 5, "a"), (2, good + "\nHome | News | Sport | Contact", 7, "b"),
            (3, good + " Read our privacy policy.\n" + good.split("\n")[0], 9, None), (4, "short", 1, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, lost_chars string")
    got = {r["doc_id"]: tuple(r)[1:] for r in line_rules.clean(df).collect()}
    assert got == {1: rows[0][1:], 2: (good, len(good), "b"), 3: (good, len(good), None)}


def test_sql_says_the_same_of_sentences(spark, tmp_path):
    """The registered SQL against the operator on lines that mix notices and text."""
    import duckdb
    filler = " ".join(f"Word{i} stands here." for i in range(30))
    notes = ["Privacy policy.", "See our terms of use! Then go on.", "Cookie policy", "A.\tSign in to continue?\u000bB.",
             "All rights reserved。 x", "No. 1 all rights reserved... and more. End", "!!! privacy policy !!!", " . "]
    rows = [(i * 10 + k, f"{n}\n{n} {filler}\n" * k + n) for i, n in enumerate(notes) for k in (1, 2, 5)]
    rows += [(900 + i, f"{filler} {n} " + "long tail " * w) for i, n in enumerate(notes) for w in (25, 100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = sorted(con.execute(line_rules.SQL).fetchall())
    got = sorted(map(tuple, line_rules.op6(spark.read.parquet(str(tmp_path / "d"))).collect()))
    assert got == want and {r[-1] for r in got} == {True, False}
