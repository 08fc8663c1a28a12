import bindings as B
import registry
from newsboard.operators import analysis as N
from newsboard.operators import routing as T
from newsboard.operators.joins import together
from newsboard.plans.incremental import IncrementalViews
from newsboard.plans.keyed import KeyedTable
from tests.helpers import analysis_rows, entry_rows, plan_of, rows


def made_rows(spark, sf_dir):
    return spark.createDataFrame([(f"a{i}", i, "Company") for i in range(50)] * 2, "feedly_id string, n int, kind string")


def shuffles(df):
    df.collect()
    return plan_of(df).split("== Physical Plan ==")[1].count("Exchange hashpartitioning")


def test_bucketed_tables_meet_without_a_shuffle(spark):
    stored = B.stored(spark, "made", made_rows, bucketed=True)
    assert rows(stored) == rows(made_rows(spark, ""))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.groupBy("feedly_id", "n").count().join(stored.select("feedly_id", "kind"), "feedly_id")
        assert shuffles(joined) == 0
        # A step that deals rows out by the article has nothing to do.
        assert shuffles(stored.repartition("feedly_id").groupBy("feedly_id", "kind").count()) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_of_unknown_size_do_not_shuffle_mentions_by_type(spark):
    entities = spark.createDataFrame(
        [(f"a{i}", "Company", f"e{i}", 0.9, 2.0) for i in range(20)],
        "feedly_id string, entity_type string, entity_id string, relevance_score double, confidence_sore double",
    )
    rules = spark.createDataFrame(
        [(1, "Company", ":x:", "1", "0.2", "0.2"), (2, None, ":y:", "1", "0.2", "0.2")],
        "concept_id int, entity_type string, emoji_icon string, entity_confidence_score_threshold string, "
        "entity_relevance_score_threshold string, topic_score_threshold string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = T.match_rules(entities, rules)
        assert matched.count() == 20
        assert "hashpartitioning(entity_type" not in plan_of(matched)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_of_a_large_table_has_more_files_in_four_batches(spark, shared):
    path = f"{shared}/rows"
    spark.range(4000).selectExpr("id", "sha2(string(id), 256) as x").write.parquet(path)
    stream = registry.file_stream(spark.read.parquet(path), "id", file_bytes=10_000)
    seen = []
    stream.writeStream.foreachBatch(lambda b, i: seen.append((b.count(), b.select("id").inputFiles()))).option(
        "checkpointLocation", f"{shared}/cp"
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and sum(n for n, _ in seen) == 4000
    assert max(n for n, _ in seen) < 2000


def test_ids_without_null_find_rows_by_the_key_itself(spark, shared):
    table = KeyedTable(spark, f"{shared}/t", ["k"], "k string, n int", 4)
    table.replace(spark.createDataFrame([("a",), ("b",), (None,)], "k string"),
                  spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int"))
    some = table.matching(spark.createDataFrame([("a",), ("a",), ("z",)], "k string"))
    assert rows(some) == [("a", 1)] and "coalesce(k" not in plan_of(some)
    assert rows(table.matching(spark.createDataFrame([("b",), (None,)], "k string"))) == [("b", 2), (None, 3)]


def test_companies_of_a_change_come_from_the_stored_entities(spark, shared, monkeypatch):
    calls = []
    real = N.analysis_entities
    organizations = B.conform(spark.createDataFrame([("o1", "Acme", "acme")], "uuid string, name string, permalink string"),
                              B.S.REGISTER["organizations"])
    views = IncrementalViews(spark, f"{shared}/v", organizations, 4)
    monkeypatch.setattr(N, "analysis_entities", lambda *a, **k: calls.append(1) or real(*a, **k))
    doc = {"entities": [{"type": ["Company"], "entityEnglishId": "Acme", "crunchbaseId": "acme"}]}
    views.apply("c", entry_rows(spark, [{"id": "a", "title": "t"}]), analysis_rows(spark, {"a": doc}))
    assert rows(views.stored()["vw_article_nlp_companies"], "feedly_id", "uuid") == [("a", "o1")]
    assert calls == [1]


def test_orders_travel_as_columns_not_as_documents(spark, shared):
    spark.sql(
        "SELECT CAST(id AS BIGINT) o_orderkey, id % 3 o_custkey, 'O' o_orderstatus, 12345.0D o_totalprice,"
        " TIMESTAMP'1998-01-01' o_orderdate, '5-LOW' o_orderpriority FROM range(6)"
    ).write.parquet(f"{shared}/orders.parquet")
    entries = B.order_entries(spark, shared)
    assert rows(entries, "feedly_id") == [(f"order/{i}",) for i in range(6)]
    plan = plan_of(entries.repartition("feedly_id")).split("== Physical Plan ==")[1]
    # One shuffle, below the step that makes the document.
    above, below = plan.split("Exchange")
    assert "AS payload" in above and "payload" not in below


def made_mentions(spark, sf_dir):
    some = [(f"a{i}", f"e{i}", ("acme", "none", None)[i % 3]) for i in range(30)] + [("a0", "f", None), ("a0", "g", "twice")]
    named = "feedly_id string, entity_id string, crunchbase_id string"
    return spark.createDataFrame(some, named).selectExpr(
        "feedly_id", "'Company' entity_type", "entity_id", "crunchbase_id", "coalesce(crunchbase_id, entity_id) entity_external_id",
        "0.5D relevance_score", "0.9D confidence_sore", "1L mentions",
    )


def test_company_mentions_stay_with_their_article(spark):
    organizations = B.conform(
        spark.createDataFrame([("o1", "Acme", "acme"), ("o2", "A", "twice"), ("o3", "B", "twice"), ("o4", "C", None)],
                              "uuid string, name string, permalink string"), B.S.REGISTER["organizations"])
    stored = B.stored(spark, "mentions", made_mentions, bucketed=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        companies = N.resolve_companies(stored, organizations).repartition("feedly_id")
        got = rows(companies, "feedly_id", "entity_id", "uuid")
        assert "Exchange hashpartitioning(feedly_id" not in plan_of(companies).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [(f"a{i}", f"e{i}", "o1" if i % 3 == 0 else None) for i in range(30)]
    assert got == sorted([*want, ("a0", "f", None), ("a0", "g", "o2"), ("a0", "g", "o3")],
                         key=lambda r: tuple((x is None, repr(x)) for x in r))


def test_companies_do_not_store_entities_for_themselves(spark, shared, monkeypatch):
    asked = []
    monkeypatch.setattr(registry, "stored_entities", lambda *a: asked.append("stored") or "stored")
    monkeypatch.setattr(registry, "entities", made_mentions)
    monkeypatch.setattr(B, "organizations", lambda *a: None)
    monkeypatch.setattr(N, "resolve_companies", lambda found, register: found)
    assert rows(registry.resolved(spark, shared)) == rows(made_mentions(spark, shared)) and not asked
    B.stored(spark, shared, made_mentions)
    assert registry.resolved(spark, shared) == "stored"


def order_tables(spark, path):
    """Six orders of two lines each; the last order comes twice."""
    orders = "SELECT CAST(o AS BIGINT) o_orderkey, o % 3 o_custkey, 'O' o_orderstatus, 12345.0D o_totalprice," \
        " TIMESTAMP'1998-01-01' o_orderdate, '5-LOW' o_orderpriority FROM VALUES (0), (1), (2), (3), (4), (5), (5) t(o)"
    lines = "SELECT CAST(id DIV 2 AS BIGINT) l_orderkey, id % 2 l_partkey, id % 3 l_suppkey, CAST(id % 2 AS INT) l_linenumber," \
        " 10.0D l_quantity, 5000.0D l_extendedprice, IF(id % 3 = 0, 'N', 'R') l_returnflag FROM range(12)"
    spark.sql(orders).write.parquet(f"{path}/orders.parquet")
    spark.sql(lines).write.parquet(f"{path}/lineitem.parquet")
    spark.sql("SELECT id p_partkey, 'a b' p_name, IF(id = 0, 'ECONOMY', 'LARGE') p_type FROM range(2)").write.parquet(
        f"{path}/part.parquet")
    spark.sql("SELECT id s_suppkey, concat('s', id) s_name FROM range(3)").write.parquet(f"{path}/supplier.parquet")


def test_large_tables_lie_in_more_buckets_than_a_shuffle_has_partitions(spark, shared, monkeypatch):
    order_tables(spark, shared)
    few = rows(registry.entities(spark, shared), "feedly_id", "entity_type", "entity_id", "mentions")
    assert len(few) == 6 * 2 * 2 and {r[-1] for r in few} == {1, 4}
    monkeypatch.setattr(B, "_STORED", {})
    monkeypatch.setattr(B, "BUCKET_BYTES", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entities = registry.entities(spark, shared)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
        # No task holds more than a bucket, and what is grouped by the article stays where it lies.
        assert shuffles(entities) == 0
        assert entities.rdd.getNumPartitions() > 4
        assert rows(entities, "feedly_id", "entity_type", "entity_id", "mentions") == few
        assert shuffles(N.pick_companies(entities)) == 0
        assert shuffles(T.match_rules(entities, B.seeds(spark)["concept_entity_rules"])) == 0
        again = registry.stored_entities(spark, shared)
        assert shuffles(again.groupBy("feedly_id").count()) == 0
        assert rows(again, "feedly_id", "entity_type", "entity_id", "mentions") == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_types_do_not_store_entities_for_themselves(spark, shared):
    order_tables(spark, shared)
    assert rows(registry.uncovered_types(spark, shared)) == [("Company",)]
    assert not B.is_stored(spark, shared, registry.entities)
    registry.stored_entities(spark, shared)
    assert rows(registry.uncovered_types(spark, shared)) == [("Company",)]


def test_rows_that_lie_apart_are_dealt_out_once(spark):
    apart = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1), (None, 3)], "k string, n int").repartition(3)
    assert rows(together(apart, "k")) == rows(apart)
    one = shuffles(apart.groupBy("k").count())
    assert one and shuffles(together(apart, "k").groupBy("k", "n").count()) == one


def test_landing_keeps_smaller_tasks_and_gives_the_session_its_values_back(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    values = lambda: [spark.conf.get(n) for n in names]
    spark.conf.set(names[2], "8m")
    try:
        before = values()
        with B._landing(spark, 9):
            assert values() == ["9", str(32 << 20), str(8 << 20)]
        assert values() == before
    finally:
        spark.conf.unset(names[2])
