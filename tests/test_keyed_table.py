import random

from pyspark.sql import functions as F

from sparkmart.plans import kok
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import incremental as S

SCHEMA = "id long, part string, v long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_ignore_equals_a_loop_and_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    rng = random.Random(3)
    schema = frame(spark, []).schema
    table = KeyedTable(spark, f"file:{tmp_path}/t", schema, ["id", "part"], rows_per_bucket=40, max_folders=3)
    held, expected, reads = set(), [], []
    for batch_id in range(6):
        batch = [(rng.randrange(4000), rng.choice("ab"), rng.randrange(10 ** 9)) for _ in range(400 if batch_id < 5 else 4)]
        batch += [(None, "a", batch_id), (7, None, batch_id)]
        m = table.insert_ignore(frame(spark, batch), batch_id, order_by=["v"])
        for r in sorted(batch, key=lambda r: r[2]):
            if None in r[:2] or r[:2] not in held:
                held.add(r[:2])
                expected.append(r)
        reads.append(m.read_rows)
        assert max(b.rows for k, b in m.buckets.items() if k >= 0) <= 40
        assert max(len(b.folders) for k, b in m.buckets.items() if k >= 0) <= 3
    assert rows(table.read()) == sorted(expected, key=str)
    assert len(expected) > 1500 and reads[-1] <= 4 * 40          # four keys: four buckets at most, whatever the table's size


def test_a_replayed_batch_and_a_vacuum_change_nothing(spark, tmp_path):
    schema = frame(spark, []).schema
    table = KeyedTable(spark, f"file:{tmp_path}/t", schema, "id", rows_per_bucket=5)
    first, second = [(i, "a", i) for i in range(30)], [(i, "b", i) for i in range(20, 50)]
    table.insert_ignore(frame(spark, first), 0)
    for _ in range(2):                                           # the second time as after a failure
        table.insert_ignore(frame(spark, second), 1)
        assert rows(table.read()) == sorted(first + [r for r in second if r[0] >= 30], key=str)
    before = rows(table.read())
    table.vacuum()
    assert rows(table.read()) == before
    table.insert_ignore(frame(spark, []), 2)
    assert rows(table.read()) == before


def test_merge_folds_held_and_new_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, n long").schema
    table = KeyedTable(spark, f"file:{tmp_path}/t", schema, "id", rows_per_bucket=8)
    rng, total, reads = random.Random(1), {}, []
    for batch_id in range(5):
        batch = [(rng.randrange(200), rng.randrange(9)) for _ in range(120 if batch_id < 4 else 2)]
        for i, n in batch:
            total[i] = total.get(i, 0) + n
        for _ in range(1 + batch_id % 2):                        # some are replayed
            m = table.merge(spark.createDataFrame(batch, schema), batch_id,
                            lambda df: df.groupBy("id").agg(F.sum("n").alias("n")))
        reads.append(m.read_rows)
    assert dict(map(tuple, table.read().collect())) == total
    assert reads[-1] <= 2 * 8


def test_two_newest_prices_are_kept_with_late_and_repeated_rows(spark, tmp_path):
    cols = "kok_price_id long, kok_product_id long, kok_discount_rate string, kok_discounted_price long"
    rng = random.Random(5)
    prices = [(i, rng.randrange(30), f"{rng.choice([0, 10, 20])}%", rng.choice([900, 1000, 1800])) for i in range(200)]
    rng.shuffle(prices)                                          # price ids arrive in any order
    full = kok.price_delta(spark.createDataFrame(prices, cols))
    state = KeyedTable(spark, f"file:{tmp_path}/s", spark.createDataFrame([], cols).schema, "kok_product_id", rows_per_bucket=10)
    for n in range(3):
        spark.createDataFrame(prices[n * 60:n * 60 + 80], cols).coalesce(1).write.mode("append").parquet(f"file:{tmp_path}/src")
        S.incremental_merge(spark, f"file:{tmp_path}/src", state.schema, state, f"file:{tmp_path}/ckpt", kok.newest_two())
    assert state.read().groupBy("kok_product_id").count().where("count > 2").isEmpty()
    assert rows(kok.price_delta(state.read())) == rows(full)
