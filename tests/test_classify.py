from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from itemtrack.operators.classify import classify

RULES = [("US", 1, "heavy;weight", "HEAVY"), ("US", 2, "large", "LARGE")]
RULE_SCHEMA = "market string, rule_no int, keyword string, blocker_type string"
OBS_SCHEMA = "market string, contribution string, reason_text string, seq long"


def run(spark, obs, rules=RULES):
    o = spark.createDataFrame([(m, c, t, i) for i, (m, c, t) in enumerate(obs)], OBS_SCHEMA)
    r = spark.createDataFrame(rules, RULE_SCHEMA)
    return [row.new_reason for row in classify(o, r).orderBy("seq").collect()]


def test_golden_classification(spark):
    obs = [("US", "OperationalRule", "too heavy and large"),
           ("US", "OperationalRule", "too large"),
           ("US", "OperationalRule", "Too Large"),
           ("US", "OperationalRule", ""),
           ("US", "OperationalRule", None),
           ("UK", "OperationalRule", "too large"),
           ("US", "SomethingElse", "too large"),
           ("US", None, "")]
    assert run(spark, obs) == ["HEAVY", "LARGE", "Others", "No blocker", "No blocker",
                               "Others", "Others", "Others"]


def test_empty_keyword_matches_everything(spark):
    rules = [("US", 1, "zzz;", "ANY"), ("US", 2, "large", "LARGE")]
    assert run(spark, [("US", "OperationalRule", "too large")], rules) == ["ANY"]


def python_first_match(rules, market, contribution, text):
    text = text or ""
    if contribution == "OperationalRule" and text != "":
        for m, _, kw, bt in sorted(rules, key=lambda r: r[1]):
            if m == market and any(k in text for k in kw.split(";")):
                return bt
        return "Others"
    if contribution == "OperationalRule":
        return "No blocker"
    return "Others"


words = st.sampled_from(["a", "b", "ab", "ba", "x", ""])


@settings(max_examples=15, deadline=None)
@given(rules=st.lists(st.tuples(st.sampled_from(["US", "UK"]),
                                st.lists(words, min_size=1, max_size=3),
                                st.sampled_from(["T1", "T2", "T3"])), min_size=0, max_size=4),
       obs=st.lists(st.tuples(st.sampled_from(["US", "UK", "DE"]),
                              st.sampled_from(["OperationalRule", "Other"]),
                              st.text(alphabet="abx ", max_size=5)), min_size=1, max_size=8))
def test_matches_plain_first_match_loop(spark, rules, obs):
    table = [(m, i + 1, ";".join(ks), bt) for i, (m, ks, bt) in enumerate(rules)]
    if not table:
        table = [("ZZ", 1, "q", "T")]
    want = [python_first_match(table, m, c, t) for m, c, t in obs]
    assert run(spark, obs, table) == want


def test_first_rule_without_a_type_still_decides(spark):
    from itemtrack.operators import classify as C
    rules = [("US", 1, "k", None), ("US", 2, "k", "SECOND"), ("UK", 1, "", "ANY")]
    obs = [("US", "OperationalRule", "has k", 0), ("US", "OperationalRule", "none", 1),
           ("UK", "OperationalRule", "x", 2), ("DE", "OperationalRule", "x", 3)]
    o, r = spark.createDataFrame(obs, OBS_SCHEMA), spark.createDataFrame(rules, RULE_SCHEMA)
    got = [x.new_reason for x in C.classify(o, r).orderBy("seq").collect()]
    assert got == [None, "Others", "ANY", "Others"]
    only = C.classify(o.withColumn("market", F.lit("US")), r)     # a constant market
    assert [x.new_reason for x in only.orderBy("seq").collect()] == [None, "Others", "Others", "Others"]


def test_many_rules_earliest_wins(spark):
    from itemtrack.operators import classify as C
    rules = [("US", i, f"k{i}", f"T{i}") for i in range(1, 8)] + [("US", 8, "k", "LAST")]
    o = spark.createDataFrame([("US", "OperationalRule", "has k5 and k2", 0)], OBS_SCHEMA)
    assert C.first_matching_rule(o, spark.createDataFrame(rules, RULE_SCHEMA)).first()["matched_type"] == "T2"


def test_rules_keep_order_per_market(spark):
    from itemtrack.operators import classify as C
    rules = [("US", 1, "zz", "US1"), ("UK", 1, "b", "UK1"), ("US", 2, "a", "US2"),
             ("UK", 2, "a", "UK2"), ("US", 3, "b", "US3"), ("UK", 3, "zz", "UK3")]
    obs = [("US", "OperationalRule", "ab", 0), ("UK", "OperationalRule", "ab", 1),
           ("UK", "OperationalRule", "a", 2), ("DE", "OperationalRule", "ab", 3)]
    o = spark.createDataFrame(obs, OBS_SCHEMA)
    r = spark.createDataFrame(rules, RULE_SCHEMA)
    got = [x.matched_type for x in C.first_matching_rule(o, r).orderBy("seq").collect()]
    assert got == ["US2", "UK1", "UK2", None]


def test_ten_thousand_keywords(spark):
    """Texts meet a large sheet by trigrams: few candidates a text, the same first rule."""
    import random
    from itemtrack.operators import classify as C
    rng = random.Random(3)

    def word(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ü\n") for _ in range(n))

    sheet = [("US", n, f"{word(rng.randint(5, 9))};{word(7)}", f"T{n}") for n in range(5000)]
    sheet += [("US", 5000, "#", "HASH"), ("US", 5001, "üü", "TWO"), ("UK", 1, "abc", "UK")]
    texts = [word(rng.randint(0, 60)) for _ in range(300)]
    texts += [word(10) + rng.choice(sheet[:5000])[2].split(";")[0] + word(9) for _ in range(200)] + ["x#x", "aüüb"]
    obs = [(rng.choice(["US", "US", "US", "UK", None]), "OperationalRule", t) for t in texts]
    assert run(spark, obs, sheet) == [python_first_match(sheet, *o) for o in obs]
    t = spark.createDataFrame([(i, m, x) for i, (m, _, x) in enumerate(obs)], "_id long, _market string, _text string")
    words = C._keywords(spark.createDataFrame(sheet, RULE_SCHEMA), ";")
    assert C.candidates(t, words).count() < 40 * len(obs)           # of 10,002 keywords for each text of US


def test_long_text_is_read_in_one_pass(spark):
    text = "äb" * 300_000 + "needle" + "c" * 300_000
    assert run(spark, [("US", "OperationalRule", text)], [("US", 1, "needle", "N")]) == ["N"]
