import pytest
from pyspark.sql import functions as F

from trolley import schema
from trolley.sources import (
    Store,
    cached,
    load_dataset,
    load_order_lists,
    load_tables,
    sample_rows,
    save_dataset,
    store_tables,
    write_ground_truth,
    write_submission,
)

# One small file per source table.
FILES = {
    "orders.csv": "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
    "1,7,prior,1,0,8,\n2,7,prior,2,6,23,30.0\n3,7,train,3,1,0,nan\n",
    "order_products__prior.csv": "order_id,product_id,add_to_cart_order,reordered\n1,65535,1,0\n2,65535,1,1\n",
    "order_products__train.csv": "order_id,product_id,add_to_cart_order,reordered\n3,65535,1,1\n",
    "products.csv": 'product_id,product_name,aisle_id,department_id\n65535,"Milk, whole",1,2\n',
    "aisles.csv": "aisle_id,aisle\n1,milk\n",
    "departments.csv": "department_id,department\n2,dairy eggs\n",
    "sample_submission.csv": "order_id,products\n9,39276 29259\n",
    "order_streaks.csv": "user_id,product_id,order_streak\n7,65535,2\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_typed_scan(spark, folder):
    tables = load_tables(spark, folder + "/")
    assert set(tables) == set(schema.CSV_FILES)
    for name, (_, types) in schema.CSV_FILES.items():
        assert tables[name].dtypes == [(f.name, f.dataType.simpleString()) for f in types]
    gaps = [r[0] for r in tables["orders"].orderBy("order_id").select("days_since_prior_order").collect()]
    assert gaps == [None, 30.0, None]
    assert tables["prior"].first()["product_id"] == 65535
    assert tables["products"].first()["product_name"] == "Milk, whole"


def test_stored_tables_join_in_place(spark, folder):
    from trolley.operators.joins import prior_detail

    loaded = load_tables(spark, folder)
    tables = store_tables(loaded, Store(spark))
    for name, frame in loaded.items():
        assert tables[name].exceptAll(frame).isEmpty() and frame.exceptAll(tables[name]).isEmpty()
    joined = prior_detail({n: f.hint("merge") for n, f in tables.items()})
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_features_from_files(spark, folder):
    from trolley.plans.features import feature_matrix

    matrix = feature_matrix(spark, load_tables(spark, folder), Store(spark))
    assert matrix.columns == schema.MATRIX
    row = matrix.first()
    assert (row["_up_order_count"], row["reordered"], row["order_streak"]) == (2, 1, 2)
    assert (row["aisle_id"], row["department_id"], row["_user_reorder_ratio"]) == (0, 0, 1.0)


def test_quotes_commas_and_large_ids(spark, folder, tmp_path):
    names = ['Say "Cheese", Please', 'Pizza, 12" Thin', '"', "plain", "a,b"]
    rows = "".join(f'{70_000_000_000 + i},"{n.replace(chr(34), chr(34) * 2)}",5,6\n' for i, n in enumerate(names))
    (tmp_path / "products.csv").write_text("product_id,product_name,aisle_id,department_id\n" + rows)
    got = load_tables(spark, folder)["products"].orderBy("product_id").collect()
    assert [r.product_name for r in got] == names
    assert [r.product_id for r in got] == [70_000_000_000 + i for i in range(5)]
    assert all((r.aisle_id, r.department_id) == (5, 6) for r in got)


@pytest.mark.parametrize("row", ["x,7,prior,1,0,8,1.0", "1,7,prior,one,0,8,1.0"])
def test_a_malformed_row_is_an_error(spark, folder, tmp_path, row):
    with (tmp_path / "orders.csv").open("a") as file:
        file.write(row + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|malformed"):
        load_tables(spark, folder)["orders"].collect()


def test_dataset_falls_back_to_csv(spark, tmp_path):
    folder = str(tmp_path)
    from pyspark.sql import types as T

    (tmp_path / "test.csv").write_text("a,b\n1,x\n")
    types = T.StructType().add("a", "long").add("b", "string")
    train = spark.createDataFrame([(1, 2.0)], "a int, b double")
    save_dataset(folder, train, None)
    got_train, got_test = load_dataset(spark, folder, types)
    assert got_train.collect() == train.collect()
    assert got_test.dtypes == [("a", "bigint"), ("b", "string")]


def test_cache_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "m")
    assert cached(spark, path, build).count() == 3
    assert cached(spark, path, build).count() == 3
    assert len(calls) == 1


def test_sinks_are_sorted(spark, tmp_path):
    lists = spark.createDataFrame([(3, "1 2"), (1, "None"), (2, "7")], "order_id int, products string")
    for write, name in ((write_submission, "s"), (write_ground_truth, "t")):
        path = str(tmp_path / name)
        write(lists.repartition(3), path)
        parts = sorted((tmp_path / name).glob("part-*.csv"))
        lines = [x for p in parts for x in p.read_text().splitlines() if x != "order_id,products"]
        assert lines == ["1,None", "2,7", "3,1 2"]
        assert load_order_lists(spark, path).count() == 3


def test_submission_name():
    from datetime import datetime

    from trolley.sources import submission_name

    at = datetime(2020, 1, 2, 3, 4, 5)
    assert submission_name(0.38, at) == "submission_2020_01_02_03_04_05_0.38.csv"


def test_scored_submission_is_found_under_its_name(spark, tmp_path):
    import datetime as dt

    from trolley.sources import write_scored_submission

    lists = spark.createDataFrame([(2, "5 7"), (1, "None")], "order_id int, products string")
    path = write_scored_submission(lists, f"{tmp_path}/", 0.38, dt.datetime(2020, 1, 2, 3, 4, 5))
    assert path == f"{tmp_path}/submission_2020_01_02_03_04_05_0.38.csv"
    assert [tuple(r) for r in load_order_lists(spark, path).orderBy("order_id").collect()] == [(1, "None"), (2, "5 7")]


def test_closed_store_leaves_no_tables(spark):
    store = Store(spark)
    name = store.put_bucketed(spark.range(4), "t", ["id"], 2)
    assert name.count() == 4
    store.close()
    assert not [t for t in spark.catalog.listTables() if store.tag in t.name]


def test_a_store_removes_its_files(spark):
    from pathlib import Path

    with Store(spark) as store:
        assert store.put(spark.range(4), "t").count() == 4
        folder = Path(store.root.removeprefix("file:"))
        assert folder.exists()
    assert not folder.exists()


def test_sample_is_stable(spark):
    df = spark.range(100)
    five = sample_rows(df, 5, seed=1).collect()
    assert five == sample_rows(df.repartition(7), 5, seed=1).collect()
    assert five != sample_rows(df, 5, seed=2).collect()
    assert sample_rows(df).count() == 100


def test_bucketed_tables_join_without_a_shuffle(spark):
    store = Store(spark)
    a = store.put_bucketed(spark.range(100).withColumn("x", F.col("id") * 2), "a", ["id"], 4)
    b = store.put_bucketed(spark.range(100), "b", ["id"], 4)
    joined = a.hint("merge").join(b, "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


class Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_is_named_on_a_cluster():
    from trolley.sources.store import scratch_root

    with pytest.raises(RuntimeError):
        scratch_root(Session("yarn"))
    local = Session("local[2]")
    assert scratch_root(local) == scratch_root(local) == local.folder


def test_a_bucket_holds_no_more_rows_than_a_task_sorts(spark):
    rows = 216_000_000
    assert rows / Store(spark).buckets_for(rows) <= 1 << 20
