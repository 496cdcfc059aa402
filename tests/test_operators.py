import random

import pytest
from pyspark.sql import functions as F

from omnishelf import operators as op
from omnishelf.functions import norm_key, split_csv
from omnishelf.operators import checks
from omnishelf.operators.matching import match_key as op_match_key
from omnishelf.operators.rollup import joined_ranked_set, joined_set
from tests.conftest import plan_of, rows


def test_keep_latest_is_total(spark):
    data = [("a", "2024-01-02", 1), ("a", "2024-01-02", 0), ("a", None, 9), ("b", None, 3)]
    data += [(None, "2024-01-01", 5), (None, "2024-01-03", 6)]
    want = [(None, "2024-01-03", 6), ("a", "2024-01-02", 0), ("b", None, 3)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, d string, v int")
        got = op.keep_latest(df, ["k"], ["d"])
        assert rows(got) == want
    # The trim runs before the exchange as well: one row per key and task is shuffled.
    assert plan_of(got).count("WindowGroupLimit") == 2


def test_latest_with_bounds(spark):
    data = [("x", "2024-01-01", 1.0), ("x", "2024-03-01", 2.0), ("x", "2024-03-01", 3.0)]
    data += [("x", None, 9.0), ("y", None, 4.0)]
    df = spark.createDataFrame(data, "k string, d string, r double")
    got = op.latest_with_bounds(df, ["k"], "d", ["r"])
    assert rows(got) == [("x", "2024-01-01", "2024-03-01", 4, 3.0), ("y", None, None, 1, 4.0)]


def _brute_force_passes(left, right):
    """All pairs, then the smallest right id per left row: (left id, right id, match type)."""
    pairs = {}
    matched_left, matched_right = set(), set()
    for name, keys in (("code", [0]), ("name", [1, 2])):
        found = [
            (lid, rid)
            for lid, *lk in left
            for rid, *rk in right
            if lid not in matched_left
            and rid not in matched_right
            and all(lk[i] is not None and lk[i] == rk[i] for i in keys)
        ]
        for lid, rid in found:
            pairs[lid] = min(pairs.get(lid, (rid, name)), (rid, name))
        matched_left |= {p[0] for p in found}
        matched_right |= {p[1] for p in found}
    out = [(lid, *pairs.get(lid, (None, None))) for lid, *_ in left]
    return out, sorted(rid for rid, *_ in right if rid not in matched_right)


def test_match_passes_equals_brute_force(spark):
    rng = random.Random(7)
    schema = "id string, code string, title string, author string"
    passes = {"code": ["code"], "name": ["title", "author"]}

    def make(prefix, n):
        return [
            (f"{prefix}{i:03d}", rng.choice([None, "1", "2", "3", "4", "5", "6"]),
             rng.choice([None, "a", "b", "c"]), rng.choice(["x", "y", None]))
            for i in range(n)
        ]

    for _ in range(3):
        left, right = make("l", 40), make("r", 15)
        matched, rest = op.match_passes(
            spark.createDataFrame(left, schema), spark.createDataFrame(right, schema),
            passes, right_id="id",
        )
        want, want_rest = _brute_force_passes(left, right)
        got = rows(matched.select("id", F.col("right.id").alias("r"), "match_type"))
        assert got == sorted(want, key=lambda r: r[0])
        assert [r[0] for r in rows(rest, "id")] == want_rest


def test_match_passes_hands_on_what_is_taken(spark):
    """The row is chosen by all its columns, of which only the wanted ones go through the shuffles."""
    left = spark.createDataFrame([("l1", "1", "a"), ("l2", "2", "b"), ("l3", None, "c")],
                                 "id string, code string, title string")
    right = spark.createDataFrame(
        [("r1", "1", "z", 1), ("r1", "1", "y", 2), ("r2", "9", "b", 3), ("r3", "8", "q", 4)],
        "id string, code string, title string, n int",
    )
    passes = {"code": ["code"], "title": ["title"]}
    whole, rest = op.match_passes(left, right, passes, right_id="id")
    taken, rest_too = op.match_passes(left, right, passes, right_id="id", take=["n"])
    assert taken.schema["right"].dataType.names == ["id", "n"]
    assert rows(rest) == rows(rest_too) == [("r3", "8", "q", 4)]
    wanted = ["id", "right.id", "right.n", "match_type"]
    assert rows(taken, *wanted) == rows(whole, *wanted) == [
        ("l1", "r1", 2, "code"), ("l2", "r2", 3, "title"), ("l3", None, None, None),
    ]


def test_match_passes_is_linear_on_a_hot_key(spark):
    """Two thousand by two thousand rows under one code give two thousand rows, not four million."""
    left = spark.range(2000).select(F.col("id"), F.lit("hot").alias("code"))
    right = spark.range(2000).select(F.col("id"), F.lit("hot").alias("code"))
    matched, rest = op.match_passes(left, right, {"code": ["code"]}, right_id="id")
    assert matched.count() == 2000 and rest.count() == 0
    assert matched.filter("right.id <> 0").count() == 0


def _outer(spark, base, watched, rated):
    keys = ["t", "y"]
    w = spark.createDataFrame(watched, "t string, y int, at string, n int")
    r = spark.createDataFrame(rated, "t string, y int, at string, stars int")
    b = spark.createDataFrame(base, "t string, y int, own string")
    spine = op.fold_histories(
        {"w": w, "r": r}, keys, latest={"w": "at", "r": "at"},
        totals={"w": {"plays": F.sum("w.n")}}, base=b, base_name="b",
    )
    return op.outer_unify(b, "b", spine, keys).select(
        "t", "y", F.col("b.own").alias("own"), "plays", F.col("r.stars").alias("stars")
    )


def test_outer_unify_all_combinations(spark):
    base = [("owr", 1, "o1"), ("owr", 1, "o2"), ("o", 1, "o3"), ("ow", 1, "o4"), ("or", 1, "o5")]
    base += [("n", None, "o6"), ("n", None, "o7")]
    watched = [("owr", 1, "2024", 2), ("owr", 1, "2023", 3), ("w", 1, "2024", 1)]
    watched += [("ow", 1, "2024", 1), ("wr", 1, "2024", 4), ("n", None, "2024", 8)]
    rated = [("owr", 1, "2024", 4), ("owr", 1, "2023", 1), ("r", 1, "2024", 5)]
    rated += [("or", 1, "2024", 3), ("wr", 1, "2024", 2), ("n", None, "2024", 1)]
    got = _outer(spark, base, watched, rated)
    assert rows(got) == sorted(
        [
            ("owr", 1, "o1", 5, 4), ("owr", 1, "o2", 5, 4), ("o", 1, "o3", None, None),
            ("ow", 1, "o4", 1, None), ("or", 1, "o5", None, 3), ("w", 1, None, 1, None),
            ("r", 1, None, None, 5), ("wr", 1, None, 4, 2),
            # An unknown year equals nothing, not even another unknown year.
            ("n", None, "o6", None, None), ("n", None, "o7", None, None),
            ("n", None, None, 8, None), ("n", None, None, None, 1),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_outer_unify_with_empty_sides(spark):
    assert rows(_outer(spark, [], [("w", 1, "2024", 1)], [])) == [("w", 1, None, 1, None)]
    assert rows(_outer(spark, [("o", 1, "o")], [], [])) == [("o", 1, "o", None, None)]


LABELS = [("folk", "Folk et monde"), ("world", "Folk et monde"), ("rock", "Rock"), ("noise", None)]


@pytest.mark.parametrize("distinct", [True, False])
def test_map_tokens_groups_labels_in_one_step(spark, distinct):
    """One shuffle counts, two join the mapping, one gathers, two join the labels back."""
    mapping = spark.createDataFrame(LABELS, "token_key string, label string")
    df = spark.createDataFrame([(1, "World, Folk")], "id int, g string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = op.map_tokens(df, split_csv("g"), mapping, "out", ["id"], distinct=distinct)
        assert plan_of(got).count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("more", [0, 1200])
def test_map_tokens_for_any_mapping(spark, more):
    """1,200 further rows of the mapping change nothing, also where rows share an id."""
    unused = [(f"unused {i}", "Other") for i in range(more)]
    mapping = spark.createDataFrame(LABELS + unused, "token_key string, label string")
    data = [(1, "World, Folk"), (2, "Noise"), (3, None), (4, "rock ,Jazz,FOLK"), (5, "")]
    df = spark.createDataFrame(data, "id int, g string")
    want = {True: ["Folk et monde", None, None, "Folk et monde,Rock", None]}
    want[False] = ["Folk et monde,Folk et monde", *want[True][1:]]
    for distinct in (True, False):
        got = op.map_tokens(df, split_csv("g"), mapping, "out", ["id"], distinct=distinct)
        assert [r.out for r in got.orderBy("id").collect()] == want[distinct]
    shared = spark.createDataFrame([(7, "Rock"), (7, "folk,rock"), (None, "Rock")], "id int, g string")
    once = op.map_tokens(shared, split_csv("g"), mapping, "out", ["id"])
    assert {(r.id, r.out) for r in once.collect()} == {(7, "Folk et monde,Rock"), (None, None)}
    every = op.map_tokens(shared, split_csv("g"), mapping, "out", ["id"], distinct=False)
    assert {r.out for r in every.filter("id = 7").collect()} == {"Folk et monde,Rock,Rock"}


@pytest.mark.parametrize("limit", ["10m", "-1"])
@pytest.mark.parametrize("distinct", [True, False])
def test_label_texts_as_map_tokens(spark, distinct, limit):
    """Rows of their own get by their text what they get by their id, however often a text occurs."""
    mapping = spark.createDataFrame(LABELS, "token_key string, label string")
    texts = ["World, Folk", "world,Folk", "Noise", None, "", " rock ,Jazz,FOLK", "rock,Rock"]
    data = [(i, text) for i, text in enumerate(texts * 3)]
    df = spark.createDataFrame(data, "id int, g string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        lookup = op.label_texts(df.select("g"), split_csv, mapping, distinct)
        got = rows(op.attach(df, lookup, {"text": "g"}, {"out": "label"}))
        assert got == rows(op.map_tokens(df, split_csv("g"), mapping, "out", ["id"], distinct))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == len(data) and lookup.count() == 4
    assert (5, texts[5], "Folk et monde,Rock") in got and (3, None, None) in got


def test_lookup_never_multiplies_rows(spark):
    names = spark.createDataFrame(
        [("Kim", "Korea"), ("KIM ", "Corea"), ("Ana", "Spain")], "author string, country string"
    )
    df = spark.createDataFrame([("kim",), ("ana",), ("bo",), (None,)], "a string")
    got = op.attach_creator_country(df, names, "author", norm_key("a"), "country")
    assert rows(got) == [(None, None), ("ana", "Spain"), ("bo", None), ("kim", "Korea")]


def test_null_safe_attach_stays_a_hash_join(spark):
    lookup = spark.createDataFrame([("t", None, 1.0), ("t", "x", 2.0)], "k string, c string, r double")
    df = spark.createDataFrame([("t", None), ("t", "x"), ("t", "y")], "k2 string, c2 string")
    got = op.attach(df, lookup, {"k": "k2", "c": "c2"}, {"rating": "r"}, null_safe=["c"])
    assert rows(got) == [("t", None, 1.0), ("t", "x", 2.0), ("t", "y", None)]
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_lookup_beyond_the_broadcast_limit_gives_the_same(spark):
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    df = spark.range(50).select((F.col("id") * 40).alias("key"))
    joined = op.attach(df, lookup, {"k": "key"}, {"v": "v"})
    assert "BroadcastHashJoin" in plan_of(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = op.attach(df, lookup, {"k": "key"}, {"v": "v"})
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert rows(shuffled) == rows(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_sources(spark):
    data = [
        ("k", 2, "b", "digital", 2, None, "x"), ("k", 1, "a", "cd", 1, 7, None),
        ("k", 2, "c", "digital", 2, 9, "w"), (None, 1, "z", "cd", 1, 1, None),
    ]
    df = spark.createDataFrame(
        data, "key string, rank int, name string, fmt string, ord int, n int, origin string"
    )
    got = op.rollup_sources(
        df, ["key"], ["rank", "name"], ["name"],
        {"n": F.max("n"), "fmt": joined_ranked_set("fmt", "ord"), "origin": joined_set("origin")},
    )
    assert rows(got) == [("k", "a", 9, "cd, digital", "w, x")]
    assert plan_of(got).count("Exchange") == 1


def test_checks_return_violations(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "A ", 6.0), (2, None, None), (None, "b", 1.0)],
        "id int, name string, r double",
    )
    assert rows(checks.unique(df, "id")) == [(1, 2)]
    assert rows(checks.case_insensitive_unique(df, "name")) == [("a", 2)]
    assert checks.not_null(df, "name").count() == 1
    assert rows(checks.accepted_values(df, "name", ["a", "b"]), "name") == [("A ",)]
    assert rows(checks.between(df, "r", 0, 5), "r") == [(6.0,)]
    parent = spark.createDataFrame([(1,), (1,)], "pid int")
    assert rows(checks.relationship(df, "id", parent, "pid"), "id") == [(2,)]
    assert rows(checks.unique_combination(df, ["id", "name"])) == []


# ---- a key that holds a third of all rows, joins too large to broadcast ---------------------


@pytest.fixture
def skewed(spark):
    """Thresholds scaled down to the test's data; the plans are those of a large table."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000, parts=8):
    """Every third row has key 0, the others are spread."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, parts).select("id", key.cast("string").alias("code"))


def split_joins(df) -> int:
    df.write.format("noop").mode("overwrite").save()
    collected = df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert collected
    return text.partition("== Initial Plan ==")[0].count("skew=true")


def test_hot_key_is_split_in_match_passes(skewed):
    left = hot(skewed)
    right = skewed.range(5000).select(
        F.concat(F.lit("r"), "id").alias("rid"), F.col("id").cast("string").alias("code")
    )
    matched, _ = op.match_passes(left, right, {"code": ["code"]}, right_id="rid")
    assert split_joins(matched) >= 1
    # The many copies on the right side of the match are split as well.
    many = hot(skewed).withColumnRenamed("id", "rid")
    few = skewed.range(3000, 5000).select("id", F.col("id").cast("string").alias("code"))
    _, rest = op.match_passes(few, many, {"code": ["code"]}, right_id="rid")
    assert split_joins(rest) >= 1


def test_hot_key_is_split_in_outer_unify(skewed):
    base = hot(skewed)
    other = skewed.range(6000).select(F.col("id").cast("string").alias("code"), F.col("id").alias("at"))
    spine = op.fold_histories({"o": other}, ["code"], {"o": "at"}, base=base, base_name="b")
    merged = op.outer_unify(base, "b", spine, ["code"])
    assert split_joins(merged) >= 1
    assert merged.count() == 60_000 + 1000


def test_pairs_of_repeated_rows_match_a_full_join(spark):
    """Owned and watched rows that repeat a key, with keys of one side only and incomplete keys."""
    rng = random.Random(5)
    key = lambda: rng.choice(["a", "b", "c", "d", None])
    for _ in range(3):
        owned = [(key(), rng.choice([1, 2, None]), i) for i in range(rng.randint(0, 12))]
        seen = [(key(), rng.choice([1, 2, None]), i) for i in range(rng.randint(0, 12))]
        base = spark.createDataFrame(owned, "t string, y int, o int")
        watched = spark.createDataFrame(seen, "t string, y int, w int")
        diary = watched.filter("w % 2 = 0").withColumnRenamed("w", "d")
        for limit in (1, 1000):
            numbers = op.numbered(base, None)
            spine = op.fold_histories(
                {"diary": diary}, ["t", "y"], {"diary": "d"}, base=numbers, base_name="owned",
                repeats={"watched": watched},
            )
            spine = op.numbered(op.attach_repeats(spine, watched, "watched", ["t", "y"]), None)
            got = op.outer_unify(
                numbers, "owned", spine, ["t", "y"], repeats="watched", pairs_per_task=limit
            )
            base.createOrReplaceTempView("b")
            watched.createOrReplaceTempView("w")
            want = spark.sql("""
                SELECT coalesce(b.t, w.t) AS t, coalesce(b.y, w.y) AS y, o, w
                FROM b FULL JOIN w ON b.t = w.t AND b.y = w.y""")
            pairs = got.select("t", "y", "owned.o", "watched.w").filter(
                "o IS NOT NULL OR w IS NOT NULL"
            )
            assert rows(pairs) == rows(want)


def test_hot_pairs_are_dealt_over_tasks(spark):
    base = spark.range(3000).selectExpr("IF(id < 900, 'hot', cast(id AS string)) AS code", "id AS o")
    watched = spark.range(1000).selectExpr("IF(id < 700, 'hot', cast(id AS string)) AS code", "id AS w")
    base = op.numbered(base, None)
    spine = op.fold_histories({}, ["code"], {}, base=base, base_name="b", repeats={"w": watched})
    spine = op.numbered(op.attach_repeats(spine, watched, "w", ["code"]), None)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = op.outer_unify(base, "b", spine, ["code"], repeats="w", pairs_per_task=10_000)
        tasks = got.filter("code = 'hot' OR b.o < 900").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    counts = [r["count"] for r in tasks]
    assert sum(counts) == 900 * 700
    assert len(counts) >= 6 and max(counts) < 900 * 700 / 3


def test_hot_key_is_split_in_lookups_and_checks(skewed):
    names = skewed.range(5000).select(F.col("id").cast("string").alias("name"), F.col("id").alias("v"))
    lookup = op.unique_lookup(names, {"k": norm_key("name")}, ["v"])
    assert split_joins(op.attach(hot(skewed), lookup, {"k": "code"}, {"v": "v"})) >= 1
    parents = skewed.range(1, 4000).select(F.col("id").cast("string").alias("p"))
    assert split_joins(checks.relationship(hot(skewed), "code", parents, "p")) >= 1


def test_hot_key_sends_one_row_per_task(skewed):
    got = op.keep_latest(hot(skewed), ["code"], ["id"])
    assert got.count() == 5000
    top = got.filter("code = '0'").collect()
    assert [r.id for r in top] == [59_997]


def test_match_key_is_unambiguous(spark):
    df = spark.createDataFrame(
        [("a|1:b", "c"), ("a", "b|1:c"), ("a", None), (None, "a"), ("", "a")], "t string, y string"
    )
    texts = {r.k for r in df.select(op_match_key(["t", "y"], "s").alias("k")).collect()}
    assert len(texts) == 5
    other = {r.k for r in df.select(op_match_key(["t", "y"], "z").alias("k")).collect()}
    assert len(texts & other) == 3
