import math
from collections import Counter

from digestlake.functions import patterns as P
from digestlake.functions import text as T
from digestlake.operators import clustering


def brute(docs, least=2, share=0.8, features=5000):
    """(doc, term) -> weight of documents that are lists of rows of words."""
    tf = {d: Counter(t for ws in rows for t in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]) for d, rows in docs.items()}
    n, df, total = sum(map(len, docs.values())), Counter(t for c in tf.values() for t in c), sum(tf.values(), Counter())
    kept = sorted((t for t in df if least <= df[t] <= share * n), key=lambda t: (-total[t], t))[:features]
    raw = {d: {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in kept if t in c} for d, c in tf.items()}
    return {(d, t): x / math.sqrt(sum(y * y for y in ws.values())) for d, ws in raw.items() for t, x in ws.items()}


def same(rows, want):
    got = {(r["id"], r["term"]): r["weight"] for r in rows}
    assert len(got) == len(rows) and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = {"1": "red fox red fox", "2": "fox red  hen", "3": "", "4": "日本 fox hen hen", "5": "cow", "6": None, "7": "red hen " * 40}


def test_weights_do_not_move(spark):
    df = clustering.tfidf(spark.createDataFrame(list(TEXTS.items()), "id string, text string"))
    assert "Exchange" not in plan(df)
    same(df.collect(), brute({k: [(v or "").split()] for k, v in TEXTS.items()}))


def test_parts_of_any_size_give_the_same(spark, monkeypatch):
    texts = {str(i): " ".join(f"w{(i * j * 7919) % 23}x" for j in range(i % 40)) for i in range(300)}
    batch = [(k, v.split()) for k, v in texts.items()]
    import pyarrow as pa

    made = pa.RecordBatch.from_arrays([pa.array([k for k, _ in batch]), pa.array([v for _, v in batch], pa.list_(pa.string()))], names=["id", "words"])
    want = Counter(t for _, w in batch for t in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    for words, docs in ((1 << 20, 1 << 16), (10, 1 << 16), (1 << 20, 3)):
        monkeypatch.setattr(clustering, "PART_WORDS", words)
        monkeypatch.setattr(clustering, "PART_DOCS", docs)
        parts = list(clustering._parts([made]))
        assert sum(p.num_rows for p in parts) == 300 and all(p.num_rows <= docs for p in parts)
        got = Counter()
        for out in clustering._counted([made]):
            for r in out.to_pylist():
                got[r["term"]] += r["total"]
        assert got == want
    same(clustering.tfidf(spark.createDataFrame(list(texts.items()), "id string, text string"), features=30).collect(), brute({k: [v.split()] for k, v in texts.items()}, features=30))


def test_rows_of_one_document_are_one(spark):
    """As in the SQL: a term counts once for a document, and no pair reaches over rows."""
    rows = [("1", "red fox"), ("1", "fox hen"), ("2", "hen red"), ("3", "cow"), (None, "red fox"), (None, "fox")]
    docs = {}
    for k, v in rows:
        docs.setdefault(k, []).append(v.split())
    same(clustering.tfidf(spark.createDataFrame(rows, "id string, text string")).collect(), brute(docs))


def test_no_documents_and_no_terms(spark):
    assert clustering.tfidf(spark.createDataFrame([], "id string, text string")).collect() == []
    assert clustering.tfidf(spark.createDataFrame([("1", "a b"), ("2", None)], "id string, text string")).collect() == []


def test_keywords_of_clusters(spark):
    rows = [(0, "red fox red fox"), (0, "fox hen"), (1, "hen hen"), (1, ""), (2, ""), (-1, "cow cow")]
    got = clustering.keywords(spark.createDataFrame(rows, "cluster int, clean_text string"))
    assert got.schema["cluster"].dataType.typeName() == "integer"
    # three clusters, one of them without terms
    tf = {0: Counter(["red", "fox", "red", "fox", "red fox", "fox red", "red fox", "fox", "hen", "fox hen"]), 1: Counter(["hen", "hen", "hen hen"])}
    idf = lambda t: math.log(4 / (1 + sum(t in c for c in tf.values()))) + 1
    for c, counts in tf.items():
        length = math.sqrt(sum((n * idf(t)) ** 2 for t, n in counts.items()))
        assert {r["term"]: round(r["weight"], 9) for r in got.where(f"cluster = {c}").collect()} == {t: round(n * idf(t) / length, 9) for t, n in counts.items()}
    assert got.where("cluster not in (0, 1)").count() == 0


def test_clean_as_one_expression_after_the_other(spark):
    from pyspark.sql import functions as F

    def plain(out):
        for pattern, to in ((r"https?://[^\s\p{Z}]+", ""), (r"t\.co/[^\s\p{Z}]+", ""), (rf"^RT{P.BLANK}+", ""), (rf"(?<!{P.WORD})via{P.BLANK}+@{P.WORD}+", ""), (rf"@{P.WORD}+", "@USER"), (rf"#({P.WORD}+)", "$1"), (rf"{P.BLANK}+", " ")):
            out = F.regexp_replace(out, pattern, to)
        return F.trim(out)

    texts = ["RT  via @x", "RThttps://a.b c", "t.http://x co/y", "  a \n b c  d　", "via @a#b via@c", "http:// t.co/ # @", "\t", "", "RT RT x", " RT x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [tuple(r) for r in df.where(~T.clean("text").eqNullSafe(plain(F.col("text")))).collect()] == []
    assert df.select(F.array_join(T.capital_entities(F.lit("(The) “Ab” x-Yz É1 _A 1A -.Fox")), "|")).first()[0] == "Ab|É1|Fox"


def test_labels_read_posts_once(spark):
    rows = [(0, "The Fox, (fox) a hen http://x @fox"), (0, "hen! hen. fox? cow\tcow"), (1, "a of"), (2, None), (3, " cow "), (None, "hen")]
    df = spark.createDataFrame(rows, "cluster int, text string")
    want = {0: "fox / hen / cow", 1: "misc", 2: "misc", 3: "cow", None: "hen"}
    assert {r["cluster"]: r["label"] for r in clustering.label_words(df).collect()} == want
    assert plan(clustering.label_words(df)).count("Scan ") == 1
    stop = spark.createDataFrame([("fox",), ("fox",), ("cow",)], "word string")
    want = {0: "hen / the", 1: "misc", 2: "misc", 3: "misc", None: "hen"}
    assert {r["cluster"]: r["label"] for r in clustering.label_words(df, stop=stop).collect()} == want


def test_letters_that_fold_to_s_and_i_are_found(spark):
    from pyspark.sql import functions as F

    texts = ["a NFT and BİTCOIN", "deep neural ſtudy", "bıtcoin", "ſpace", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(F.array_join(T.topics("text"), "|")).collect()] == ["crypto", "ai|science", "crypto", "science", "general"]


def test_terms_that_cannot_be_in_the_vocabulary_are_not_counted(spark):
    texts = {str(i): " ".join(f"w{(i * 31 + j * j * 7919) % (7 if j % 3 else 997)}x" for j in range(60)) + " common" for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "id string, text string")
    for features in (1, 12, 40, 100000):
        same(clustering.tfidf(docs, features=features).collect(), brute({k: [v.split()] for k, v in texts.items()}, features=features))
    heavy = clustering._heavy(docs.select(clustering.words("text").alias("words")), 2, 160, 12)
    assert 12 <= heavy.sum() < 100 and clustering._heavy(docs.select(clustering.words("text").alias("words")), 2, 160, 100000).sum() > 1000
