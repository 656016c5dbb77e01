"""Dumps loaded into tables again."""

import pytest
from pyspark.sql import functions as F

from blockweave import queries
from blockweave.functions import uint256
from blockweave.operators import completions, sinks, transform
from blockweave.plans import reload
from blockweave.schemas import DUMP_TABLES, TABLES
from blockweave.sources import dump

SF = "/root/testdata/sf0.001"
LOGS = [["0xa", "0xöß", ""], [], None]


def rows_of(df):
    return sorted(str(r) for r in df.collect())


def dumped(tables):
    rows = None
    for name, table in tables.items():
        part = dump.to_values(table, name, F.floor(F.col("number" if name == "blocks" else "block_number") / 8))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def test_lists(spark):
    log = [1, 2, 3, 4, 5, 6, "0xa", "0xd", "t0", None, None, None]
    logs = spark.createDataFrame([(*log, rest, "0xh", removed) for rest in LOGS for removed in (True, False)], TABLES["logs"])
    back = dump.from_values(dump.to_values(logs, "logs", F.lit(0)), "logs", logs.columns).drop("batch_id")
    assert back.schema.simpleString() == logs.schema.simpleString() and rows_of(back) == rows_of(logs)


@pytest.mark.parametrize("way", ["at once", "twice", "steps", "paced"])
def test_reload_gives_all_tables_back(spark, tmp_path, way):
    root, blocks = str(tmp_path / "t"), "block_num < 25078024" if way == "paced" else "true"
    decoded = queries._decoded(spark, SF).where(blocks)
    dump.write(dumped(transform.entities(decoded, value=uint256.varint)), str(tmp_path / "d"))
    rows = dump.read(spark, str(tmp_path / "d"))
    if way == "paced":
        reload.paced(reload.by_block(rows.where("batch_id = 3134750")), root, "10 milliseconds")
        decoded = decoded.where("block_num between 25078000 and 25078007")
    else:
        for _ in range(1 + (way == "twice")):
            reload.load(rows, root, 8 if way == "steps" else None)
    wanted = {**transform.entities(decoded), "block_completions": completions.markers(decoded)}
    assert set(wanted) == {*DUMP_TABLES, "block_completions"}
    for name, table in wanted.items():
        stored = sinks.read_table(spark, root, name)
        assert rows_of(stored.select(*table.columns)) == rows_of(table) and stored.count() > 0, name
