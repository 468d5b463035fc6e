import itertools
import random

from pyspark.sql import functions as F

from ledgerlark.functions.text import toxicity_score
from ledgerlark.operators import lexicon
from ledgerlark.operators.lexicon import lexicon_matches, with_toxicity


def random_text(rng, n):
    return "".join(rng.choice("abcdeé ") for _ in range(n))


def test_ten_thousand_words_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [random_text(rng, rng.randrange(60)) for _ in range(200)]
    texts = [t + " common passage" if i % 3 == 0 else t for i, t in enumerate(texts)]  # a hot piece
    texts += ["", None, "MIXED Case ABC", "x" * 20_000 + "needle"]
    words = {random_text(rng, rng.randrange(1, 9)) for _ in range(10_000)}
    words |= {"common", "needle", "a", "bé", "case", "Case", "passage common"}
    df = spark.createDataFrame([(i, 7, t) for i, t in enumerate(texts)], "id int, other int, said string")
    lexicon = spark.createDataFrame([(w,) for w in words] * 2 + [(None,), ("",)], "word string")
    got = {(r.id, r.word) for r in lexicon_matches(df, ["id", "other"], "said", lexicon).collect()}
    assert got == {(i, w) for i, t in enumerate(texts) if t for w in words if w in t.lower()}


def test_score_equals_the_text_function(spark):
    words = ["hate", "ha", "t", "ate", "none of it"]
    rows = [(1, "Hate"), (2, "a hat"), (3, "who"), (4, ""), (5, None), (6, "hat")]
    df = spark.createDataFrame(rows, "id int, said string")
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    scored = with_toxicity(df, ["id"], "said", lexicon)
    want = df.withColumn("toxicity_score", toxicity_score(F.col("said"), words))
    assert sorted(scored.select(want.columns).collect()) == sorted(want.collect())
    none = with_toxicity(df, ["id"], "said", lexicon.where("word = 'zz'"))
    assert {r.toxicity_score for r in none.collect()} == {0.0}
    assert with_toxicity(df.where("id > 9"), ["id"], "said", lexicon).count() == 0


def test_plan_does_not_grow_with_the_words(spark):
    df = spark.createDataFrame([(1, "some text")], "id int, said string")
    sizes = []
    for n in (10, 5_000):
        lexicon = spark.range(n).select(F.concat(F.lit("tex"), F.col("id")).alias("word"))
        plan = lexicon_matches(df, ["id"], "said", lexicon)._jdf.queryExecution().executedPlan().toString()
        sizes.append(plan.count("\n"))
    assert sizes[0] == sizes[1]


def test_words_longer_than_a_piece_and_texts_longer_than_a_stretch(spark):
    edge = lexicon.STRETCH - 3
    long = "l" * lexicon.PIECE
    texts = ["." * edge + "crossing" + "." * 300, long + "yes and no", long, "é" * 255 + long + "yes", "𝒳y" * 200 + "Crossing"]
    words = ["crossing", long, long + "yes", long + "no", "𝒳y𝒳", long * 3, "y" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, said string")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r.id, r.word) for r in lexicon_matches(df, ["id"], "said", listed).collect()}
    assert got == {(i, w) for i, t in enumerate(texts) for w in words if w in t.lower()}


def test_what_is_looked_up_grows_with_the_text_alone(spark):
    """Words made of the commonest pieces are not each searched for in every text that holds such pieces."""
    text = "".join(f"{a}{b}" for a in "abcd" for b in "abcd") * 4
    df = spark.createDataFrame([(i, text) for i in range(20)], "id int, said string")
    words = ["".join(w) for w in itertools.product("abcd", repeat=6)]
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    plan = lexicon_matches(df, ["id"], "said", listed)
    assert {(r.id, r.word) for r in plan.collect()} == {(i, w) for i in range(20) for w in words if w in text}
    assert "Contains" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert lexicon.text_pieces(df.withColumnRenamed("said", "_text"), ["id"], [6]).count() <= 20 * len(text)


def test_few_pieces_travel_that_are_no_words(spark, monkeypatch):
    """Neither a lexicon's many lengths nor long texts make a row of every substring."""
    rng = random.Random(3)
    texts = [random_text(rng, 400) + "日本 Word" for _ in range(50)]
    words = {"".join(rng.choice("vwxyz") for _ in range(rng.randrange(4, 21))) for _ in range(3_000)}
    words |= {"日本", "word", "本 word", *(t[50:70].lower() for t in texts)}
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, "word"), (None, "word")], "id int, said string")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    made, cut = [], lexicon.text_pieces
    monkeypatch.setattr(lexicon, "text_pieces", lambda *a: made.append(cut(*a)) or made[-1])
    got = [tuple(r) for r in lexicon_matches(df, ["id"], "said", listed).collect()]
    want = {(i, w) for i, t in enumerate(texts) for w in words if w in t.lower()} | {(None, "word")}
    assert set(got) == want and len(got) == len(want)
    assert made[0].count() < sum(map(len, texts)) // 10
