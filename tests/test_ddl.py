"""DDL classification: statement forms, quoting, lists, key changes and what is not understood."""

import pytest

from tidemark.operators.ddl import ddl_changelog, schema_notices


def parse(spark, *ddls):
    df = spark.createDataFrame([("shop.t", i, d) for i, d in enumerate(ddls)], "source_key string, seq long, ddl string")
    return [tuple(r)[1:] for r in ddl_changelog(df).orderBy("seq", "clause_no").collect()]


FORMS = [
    ("ALTER TABLE `stock`\n ADD PRIMARY KEY ( `sku`, `store` )", [("add_key", None, None, "sku,store", "none")]),
    ("\talter   TABLE stock\n\n  rename\tstock_2019 ", [("rename_table", "stock", "stock_2019", None, "rename_source")]),
    ("alter table stock rename as old_stock", [("rename_table", "stock", "old_stock", None, "rename_source")]),
    ("rename table stock to s1, bins to b1", [("rename_table", "stock", "s1", None, "rename_source"), ("rename_table", "bins", "b1", None, "rename_source")]),
    ("alter table stock rename column qty to amount", [("rename_column", "qty", "amount", None, "rename_column")]),
    ("alter table stock rename index i1 to i2", [("noop", None, None, None, "none")]),
    ("alter table stock change qty qty bigint not null", [("noop", "qty", "qty", None, "none")]),
    ("alter table stock change column qty amount decimal(9,3) after sku", [("change_column", "qty", "amount", None, "rename_column")]),
    ("alter table stock modify qty int unsigned", [("modify_column", "qty", None, None, "none")]),
    ("alter table stock add price decimal(12,4) comment 'net, per unit'", [("add_column", "price", None, None, "none")]),
    ('alter table stock add note text default "a, (b", drop old_note', [("add_column", "note", None, None, "none"), ("drop_column", "old_note", None, None, "drop_column")]),
    ("alter table stock add column (a set('x','y'), b int)", [("add_column", "a", None, None, "none"), ("add_column", "b", None, None, "none")]),
    ("alter table stock drop primary key", [("drop_key", None, None, None, "stop")]),
    ("alter table stock drop primary key, add constraint pk primary key (sku), engine=innodb", [("drop_key", None, None, None, "rekey"), ("add_key", None, None, "sku", "rekey"), ("noop", None, None, None, "none")]),
    ("alter table stock drop partition p7, drop constraint c1, drop check c2, drop index i", [("noop", None, None, None, "none")] * 4),
    ("alter table stock add check (qty > 0), add unique (sku, qty), add index (qty)", [("noop", None, None, None, "none")] * 3),
    ("alter table stock drop column partition", [("drop_column", "partition", None, None, "drop_column")]),
    ('alter table stock comment = "goods, in store"', [("noop", None, None, None, "none")]),
    ("truncate table stock", [("truncate", "stock", None, None, "wipe")]),
    ("drop table if exists stock", [("drop_table", "stock", None, None, "wipe")]),
    ("create table stock (sku int, primary key (sku))", [("create", "stock", None, None, "refresh_mapping")]),
    ("grant select on stock to clerk", [("unknown", None, None, None, "error")]),
    ("alter table stock shuffle rows", [("unknown", None, None, None, "error")]),
    ("alter table stock drop column if exists qty", [("drop_column", "qty", None, None, "drop_column")]),
    ("alter table if exists stock add column if not exists a int, modify column if exists b text", [("add_column", "a", None, None, "none"), ("modify_column", "b", None, None, "none")]),
    ("alter table stock add note text comment 'it\\'s, drop column b', drop c ;", [("add_column", "note", None, None, "none"), ("drop_column", "c", None, None, "drop_column")]),
    ("/* one */ -- two\n# three\nalter table stock drop column a;", [("drop_column", "a", None, None, "drop_column")]),
    ("alter table stock drop primary key, add primary key using btree (a(10), `b` desc)", [("drop_key", None, None, None, "rekey"), ("add_key", None, None, "a,b", "rekey")]),
    ("alter table stock add constraint pk primary key using hash (a)", [("add_key", None, None, "a", "none")]),
    ("rename table a to tmp, b to a, tmp to b;", [("rename_table", "a", "tmp", None, "rename_source"), ("rename_table", "b", "a", None, "rename_source"), ("rename_table", "tmp", "b", None, "rename_source")]),
]


@pytest.fixture(scope="module")
def parsed(spark):
    out: dict = {}
    for seq, no, *rest in parse(spark, *(f for f, _ in FORMS)):
        out.setdefault(seq, []).append((no, tuple(rest)))
    return out


@pytest.mark.parametrize("i", range(len(FORMS)))
def test_form(parsed, i):
    assert parsed[i] == list(enumerate(FORMS[i][1], 1))


def test_notices_leave_out_what_is_not_understood(spark):
    df = spark.createDataFrame([("s.t", i, d) for i, (d, _) in enumerate(FORMS)], "source_key string, seq long, ddl string")
    got = {r.seq for r in schema_notices(df).collect()}
    assert got == {i for i, (_, rows) in enumerate(FORMS) if all(r[-1] != "error" for r in rows)}


def test_nothing_is_shuffled(spark):
    df = spark.createDataFrame([("s.t", 1, "truncate table t")], "source_key string, seq long, ddl string")
    assert "Exchange" not in ddl_changelog(df)._jdf.queryExecution().executedPlan().toString()
