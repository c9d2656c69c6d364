"""Stand-in change logs derived from the test tables.

These builders only fabricate input rows in the change-log schema
(``tidemark.schema.CHANGELOG``) from the given tables; they do none of the
operators' work.  Every operator must be right on any log of that schema,
so nothing in ``tidemark.operators`` relies on how these rows are made.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import CHANGELOG_COLUMNS, IMAGE
from tidemark.sources.tables import table

ORDERS_SOURCE = "shop.orders"
EVENTS_SOURCE = "app.users"


def _empty() -> Column:
    return F.lit(None).cast(IMAGE)


# Rows of a fabricated log in one task, and in one landed file.
ROWS_PER_TASK = 100_000
ROWS_PER_FILE = 50_000


def rows_of(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """An upper bound for the rows of the logs fabricated from these tables (two changes a row); parquet footers tell it."""
    return 2 * sum(table(spark, sf_dir, n).count() for n in names)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Spread a fabricated log of at most ``rows`` rows over the cluster, ``ROWS_PER_TASK`` a task.

    The test tables are single-row-group files, so a log derived from one
    is produced by one task; a real change log arrives as many files.
    Hash partitioning on ``seq`` (deterministic on retry, no sort needed)
    gives the operators an input laid out like a real log.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)), "seq")


def cell(name: str, value: Column, *, key: bool = False, updated: Column | bool = True, null: Column | bool | None = None) -> Column:
    """One image cell; ``null`` defaults to "value is null"."""
    v = value.cast("string")
    is_null = v.isNull() if null is None else (F.lit(null) if isinstance(null, bool) else null)
    upd = F.lit(updated) if isinstance(updated, bool) else updated
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(key).alias("is_key"),
        upd.alias("updated"),
        is_null.alias("is_null"),
        (v if null is None else F.when(~is_null, v)).alias("value"),
    )


def image(*cells: Column) -> Column:
    return F.array(*cells)


def _log(df: DataFrame, src: str, exec_time: Column, op: str, seq: Column, before: Column, after: Column) -> DataFrame:
    db, tb = src.split(".", 1)
    return df.select(
        F.lit(src).alias("source_key"),
        F.lit(db).alias("database"),
        F.lit(tb).alias("table"),
        exec_time.cast("timestamp_ntz").alias("exec_time"),
        F.lit(op).alias("op"),
        F.lit(None).cast("string").alias("ddl"),
        seq.cast("long").alias("seq"),
        before.alias("before"),
        after.alias("after"),
    )


def orders_values() -> dict[str, Column]:
    """Text form of an orders row (money as integer cents, dates as yyyy-MM-dd)."""
    return {
        "o_orderkey": F.col("o_orderkey").cast("string"),
        "o_custkey": F.col("o_custkey").cast("string"),
        "o_orderstatus": F.col("o_orderstatus"),
        "o_totalprice": F.round(F.col("o_totalprice") * 100).cast("long").cast("string"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "o_orderpriority": F.col("o_orderpriority"),
    }


ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of ``shop.orders`` (key ``o_orderkey``), FIXTURES.md 4.1.

    INSERT every order; UPDATE a third (status 'U', price null not updated,
    priority null and updated); DELETE a seventh (priority null in the
    before-image); re-INSERT a 21st with status 'R' and no priority.
    """
    o = table(spark, sf_dir, "orders")
    v = orders_values()
    k = F.col("o_orderkey")

    def full(status: Column | None = None, priority_null: bool = False, updated: bool = True) -> Column:
        cells = []
        for name, val in v.items():
            if name == "o_orderstatus" and status is not None:
                val = status
            if name == "o_orderpriority" and priority_null:
                val = F.lit(None).cast("string")
            cells.append(cell(name, val, key=(name == "o_orderkey"), updated=updated))
        return image(*cells)

    ins = _log(o, ORDERS_SOURCE, F.col("o_orderdate"), "INSERT", k * 10, _empty(), full())
    upd_after = image(
        cell("o_orderkey", v["o_orderkey"], key=True, updated=False),
        cell("o_custkey", v["o_custkey"], updated=False),
        cell("o_orderstatus", F.lit("U"), updated=True),
        cell("o_totalprice", F.lit(None), updated=False),
        cell("o_orderdate", v["o_orderdate"], updated=False),
        cell("o_orderpriority", F.lit(None), updated=True),
    )
    upd = _log(o.where(k % 3 == 0), ORDERS_SOURCE, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "UPDATE", k * 10 + 1, full(updated=False), upd_after)
    dele = _log(o.where(k % 7 == 0), ORDERS_SOURCE, F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"), "DELETE", k * 10 + 2,
                full(priority_null=True, updated=False), _empty())
    reins = _log(o.where(k % 21 == 0), ORDERS_SOURCE, F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS"), "INSERT", k * 10 + 3,
                 _empty(), full(status=F.lit("R"), priority_null=True))
    return spread(ins.unionByName(upd).unionByName(dele).unionByName(reins), rows_of(spark, sf_dir, "orders"))


def events_values() -> dict[str, Column]:
    return {
        "user_id": F.col("user_id").cast("string"),
        "event_type": F.col("event_type"),
        "value": F.round(F.col("value") * 100).cast("long").cast("string"),
        "props": F.col("props"),
    }


EVENTS_COLUMNS = ["user_id", "event_type", "value", "props"]


def events_changelog(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Change log of ``app.users`` (key ``user_id``), FIXTURES.md 4.2.

    signup -> INSERT, view/click/purchase -> UPDATE, error -> DELETE;
    ``seq = event_id``, ``exec_time = ts``.  On UPDATE with ``event_id % 5 = 0``
    the value cell is null, flagged updated when ``event_id % 10 = 0``.

    With ``tasks``, rows of the table are dealt to so many tasks, which make the changes, in place of ``spread``.
    """
    e = table(spark, sf_dir, "events")
    if tasks is not None:
        e = e.repartition(tasks, "event_id")
    v = events_values()
    et = F.col("event_type")
    op = F.when(et == "signup", "INSERT").when(et == "error", "DELETE").otherwise("UPDATE")
    is_upd = op == "UPDATE"
    null_value = is_upd & (F.col("event_id") % 5 == 0)
    img = image(
        cell("user_id", v["user_id"], key=True),
        cell("event_type", v["event_type"]),
        cell("value", F.when(~null_value, v["value"]), updated=F.when(null_value, F.col("event_id") % 10 == 0).otherwise(True)),
        cell("props", v["props"]),
    )
    log = e.select(
        F.lit(EVENTS_SOURCE).alias("source_key"),
        F.lit("app").alias("database"),
        F.lit("users").alias("table"),
        F.col("ts").cast("timestamp_ntz").alias("exec_time"),
        op.alias("op"),
        F.lit(None).cast("string").alias("ddl"),
        F.col("event_id").cast("long").alias("seq"),
        F.when(op == "DELETE", img).otherwise(_empty()).cast(IMAGE).alias("before"),
        F.when(op != "DELETE", img).otherwise(_empty()).cast(IMAGE).alias("after"),
    ).select(*CHANGELOG_COLUMNS)
    return log if tasks is not None else spread(log, rows_of(spark, sf_dir, "events"))


CONVERSATIONS_SOURCE = "chat.conversations"
CONVERSATIONS_COLUMNS = ["conv_id", "turn", "role", "text"]


def conversations_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT of every turn of ``chat.conversations`` (composite key conv_id, turn),
    then an UPDATE of every assistant turn appending " (edited)" to its
    text; ``seq`` = 2 * (conv_id * 1000 + turn) (+1 for the update)."""
    c = table(spark, sf_dir, "conversations")
    base = F.col("conv_id") * 1000 + F.col("turn")
    t0 = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")

    def img(text: Column, text_updated: bool, updated: bool) -> Column:
        return image(
            cell("conv_id", F.col("conv_id"), key=True, updated=updated),
            cell("turn", F.col("turn"), key=True, updated=updated),
            cell("role", F.col("role"), updated=updated),
            cell("text", text, updated=text_updated),
        )

    ins = _log(c, CONVERSATIONS_SOURCE, t0 + F.make_interval(secs=F.col("turn")), "INSERT", base * 2, _empty(), img(F.col("text"), True, True))
    upd = _log(c.where(F.col("role") == "assistant"), CONVERSATIONS_SOURCE, t0 + F.expr("INTERVAL 1 DAY") + F.make_interval(secs=F.col("turn")),
               "UPDATE", base * 2 + 1, img(F.col("text"), False, False), img(F.concat(F.col("text"), F.lit(" (edited)")), True, False))
    return spread(ins.unionByName(upd), rows_of(spark, sf_dir, "conversations"))


def party_shards(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Shards feeding one destination (FIXTURES.md 4.3): customer split by
    ``c_custkey % 2``, supplier renamed to customer columns, plus nation as a
    table the shard pattern must not pick."""
    cu = table(spark, sf_dir, "customer")
    su = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal")
    )
    return {
        "shop_a.customer_0": cu.where(F.col("c_custkey") % 2 == 0),
        "shop_a.customer_1": cu.where(F.col("c_custkey") % 2 == 1),
        "shop_b.supplier": su,
        "shop_a.nation": table(spark, sf_dir, "nation"),
    }


def ddl_changelog_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema events derived from ``part`` rows: one DDL statement per part,
    on table ``parts_<brand number>``, naming a column after the part name.
    The statement form cycles through 30 templates by ``p_partkey``
    (add/drop/change column, key changes, renames, truncate, drop table,
    partitions, constraints, column lists, quotes, escapes, remarks, options, a
    statement that is not understood, and a QUERY event without schema change)."""
    p = table(spark, sf_dir, "part")
    nm = F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "_")
    tbl = F.concat(F.lit("parts_"), F.regexp_extract(F.lower("p_brand"), "([0-9]+)", 1))
    sz = F.col("p_size").cast("string")
    t = F.col("p_partkey") % 30
    nl = F.lit("\n")
    forms = [
        F.concat(F.lit("ALTER TABLE `"), tbl, F.lit("` ADD COLUMN `"), nm, F.lit("` varchar(64) COMMENT 'size, "), sz, F.lit("'")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop column "), nm),
        F.concat(F.lit("alter table "), tbl, nl, F.lit(" change "), nm, F.lit(" "), nm, F.lit("_v2 decimal(10,2) default '1,5'")),
        F.concat(F.lit("alter table "), tbl, F.lit(" change column "), nm, F.lit(" "), nm, F.lit(" bigint")),
        F.concat(F.lit("ALTER TABLE "), tbl, nl, F.lit("  DROP PRIMARY KEY,"), nl, F.lit("  ADD PRIMARY KEY (`id`, `"), nm, F.lit("`)")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop primary key")),
        F.concat(F.lit("alter table "), tbl, F.lit(" add primary key (id)")),
        F.concat(F.lit("rename table "), tbl, F.lit(" to "), nm, F.lit("_t, "), nm, F.lit("_x to "), nm, F.lit("_y")),
        F.concat(F.lit("alter table "), tbl, F.lit(" rename to "), nm, F.lit("_t")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop foreign key fk_"), sz),
        F.concat(F.lit("truncate table "), tbl),
        F.concat(F.lit("alter table "), tbl, F.lit(" auto_increment="), sz),
        F.lit("flush tables"),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop partition p"), sz),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop constraint ck_"), sz, F.lit(", drop check ck_"), nm),
        F.concat(F.lit("alter table "), tbl, F.lit(" add column ("), nm, F.lit(" decimal(8,3) default \"1,5\", "), nm, F.lit("_b int)")),
        F.concat(F.lit("alter table "), tbl, F.lit(" add column "), nm, F.lit(" varchar(9) default \"a,b\", drop column "), nm, F.lit("_old")),
        F.concat(F.lit("alter table "), tbl, F.lit(" comment='parts, sold'")),
        F.concat(F.lit("drop table if exists `"), tbl, F.lit("`")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop column `partition`, add partition (partition p"), sz, F.lit(" values less than ("), sz, F.lit("))")),
        F.concat(F.lit("alter table "), tbl, F.lit(" frobnicate "), nm),
        F.concat(F.lit("create table "), tbl, F.lit(" (id int, primary key (id))")),
        F.concat(F.lit("alter table if exists "), tbl, F.lit(" drop column if exists "), nm, F.lit(";")),
        F.concat(F.lit("/* by hand;\n drop column x */ ALTER TABLE "), tbl, F.lit(" DROP "), nm, F.lit(" ;\n")),
        F.concat(F.lit("alter table "), tbl, F.lit(" add column "), nm, F.lit(" text comment 'it\\'s, drop column b'")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop primary key, add primary key using btree (id, `"), nm, F.lit("`(10) desc)")),
        F.concat(F.lit("rename table "), tbl, F.lit(" to "), nm, F.lit("_tmp, "), nm, F.lit("_b to "), tbl, F.lit(", "), nm, F.lit("_tmp to "), nm, F.lit("_b")),
        F.concat(F.lit("-- later\n# again\nalter table "), tbl, F.lit(" add column if not exists "), nm, F.lit(" char(9) default 'a\\',b'")),
        F.concat(F.lit("alter table "), tbl, F.lit(" drop index if exists i_"), sz, F.lit(", drop column "), nm, F.lit("_old")),
        F.concat(F.lit("alter table "), tbl, F.lit(" change column if exists "), nm, F.lit(" "), nm, F.lit("_v3 int")),
    ]
    ddl = None
    for i, f in enumerate(forms):
        ddl = F.when(t == i, f) if ddl is None else ddl.when(t == i, f)
    op = F.when(t.isin(7, 26), "RENAME").when(t == 10, "TRUNCATE").when(t == 12, "QUERY").when(t == 18, "ERASE").when(t == 21, "CREATE").otherwise("ALTER")
    return p.select(
        F.concat(F.lit("shop."), tbl).alias("source_key"),
        F.lit("shop").alias("database"),
        tbl.alias("table"),
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("p_partkey"))).alias("exec_time"),
        op.alias("op"),
        ddl.alias("ddl"),
        F.col("p_partkey").cast("long").alias("seq"),
        _empty().alias("before"),
        _empty().alias("after"),
    )


def orders_truncate_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One TRUNCATE of ``shop.orders`` ordered between the changes of the lower
    and upper half of the order keys (``seq = floor(max key / 2) * 10 + 5``)."""
    o = table(spark, sf_dir, "orders")
    return o.agg((F.floor(F.max("o_orderkey") / 2) * 10 + 5).cast("long").alias("seq"), F.max("o_orderdate").alias("exec_time")).select(
        F.lit(ORDERS_SOURCE).alias("source_key"), F.lit("shop").alias("database"), F.lit("orders").alias("table"),
        F.col("exec_time").cast("timestamp_ntz").alias("exec_time"), F.lit("TRUNCATE").alias("op"),
        F.lit("truncate table orders").alias("ddl"), "seq", _empty().alias("before"), _empty().alias("after"),
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stand-in log once to the shared scratch folder and read it back.

    A real change log lives in storage; operators that scan their input more
    than once (quantile bounds, block tails, two plan branches) then read the
    table instead of rebuilding the stand-in each time.  Each call writes a
    new folder under ``spark.checkpoint.dir``.
    """
    import uuid

    from tidemark.session import scratch_path

    path = scratch_path(df.sparkSession, f"logs/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def orders_schema_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ALTER events of ``shop.orders`` placed between row changes by
    ``seq`` (m = max order key): at ``10*floor(m/3)+5`` o_orderstatus is
    renamed o_status, at ``10*floor(m/2)+5`` o_status is renamed o_state, at
    ``10*floor(2m/3)+5`` o_orderpriority is dropped."""
    o = table(spark, sf_dir, "orders")
    m = F.max("o_orderkey")
    evs = F.array(
        F.struct((F.floor(m / 3) * 10 + 5).cast("long").alias("seq"), F.lit("alter table orders change o_orderstatus o_status char(1)").alias("ddl")),
        F.struct((F.floor(m / 2) * 10 + 5).cast("long").alias("seq"), F.lit("ALTER TABLE `orders` CHANGE COLUMN `o_status` `o_state` varchar(2)").alias("ddl")),
        F.struct((F.floor(m * 2 / 3) * 10 + 5).cast("long").alias("seq"), F.lit("alter table orders drop column o_orderpriority").alias("ddl")),
    )
    return o.agg(evs.alias("e"), F.max("o_orderdate").alias("t")).select(F.explode("e").alias("e"), "t").select(
        F.lit(ORDERS_SOURCE).alias("source_key"), F.lit("shop").alias("database"), F.lit("orders").alias("table"),
        F.col("t").cast("timestamp_ntz").alias("exec_time"), F.lit("ALTER").alias("op"), F.col("e.ddl").alias("ddl"),
        F.col("e.seq").alias("seq"), _empty().alias("before"), _empty().alias("after"),
    )


def _staged(df: DataFrame, chunk: Column) -> tuple[str, dict[int, int]]:
    """Write a stand-in log once, by chunk; returns the folder and, for each chunk, the number of files that its
    rows make. There are as many tasks as files, and a chunk's rows are dealt to as many as the largest has."""
    import uuid

    from tidemark.session import scratch_path

    spark = df.sparkSession
    staged = scratch_path(spark, f"staged/{uuid.uuid4().hex}")
    held = df.withColumn("_chunk", chunk)
    files = {r["_chunk"]: -(-r["count"] // ROWS_PER_FILE) for r in held.groupBy("_chunk").count().collect()}  # a row for each chunk
    most = max(files.values(), default=1)
    tasks = max(sum(files.values()), spark.sparkContext.defaultParallelism)
    held.repartition(tasks, "_chunk", F.pmod(F.xxhash64("seq"), F.lit(most))).write.partitionBy("_chunk").parquet(staged)
    return staged, files


def _land_chunk(df: DataFrame, staged: str, chunk: int, path: str, files: int) -> None:
    """Land one staged chunk as ``files`` files; rows dealt by ``seq``, so no task sorts them."""
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{staged}/_chunk={chunk}")
    rows.repartition(files, "seq").write.mode("append").parquet(path)


def _land(df: DataFrame, chunk: Column, path: str, files: int) -> int:
    """Land the chunks of a stand-in log one after another, each as distributed writes of equally many files, the way
    a live feed lands them; returns their number: a micro-batch of so many files is one chunk.  There are ``files`` of
    them, or one for ``ROWS_PER_FILE`` rows of the largest chunk; a chunk with too few rows gets empty files too.
    A chunk is derived from the tables by itself, so its rows are shuffled once, by ``seq``, and not sorted."""
    spark = df.sparkSession
    held = df.withColumn("_chunk", chunk)
    sizes = {r["_chunk"]: -(-r["count"] // ROWS_PER_FILE) for r in held.groupBy("_chunk").count().collect()}  # a row for each chunk
    each = max(files, *sizes.values()) if sizes else files
    landed = 0
    for c in sorted(sizes):
        held.where(F.col("_chunk") == c).drop("_chunk").repartition(each, "seq").write.mode("append").parquet(path)
        landed += each
        if each > 1:
            for _ in range(landed - len(spark.read.parquet(path).inputFiles())):
                spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return each


def land_years(df: DataFrame, path: str) -> Iterator[int]:
    """Land a stand-in log year by year from its first to its last, an empty year as one empty file; gives each year
    when its files are there."""
    lo, hi = df.agg(F.year(F.min("exec_time")), F.year(F.max("exec_time"))).first()
    staged, sizes = _staged(df, F.year("exec_time") - F.lit(lo))
    for c in range(hi - lo + 1):
        if c in sizes:
            _land_chunk(df, staged, c, path, sizes[c])
        else:
            df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
        yield lo + c


def files_for(rows: int, files: int) -> int:
    """How many files stand for each of ``files`` when a log of ``rows`` rows lands with ``ROWS_PER_FILE`` rows a file."""
    return max(1, -(-rows // (files * ROWS_PER_FILE)))


def write_shuffled(df: DataFrame, path: str, files: int, rows: int) -> int:
    """Land a log of at most ``rows`` rows in any order as ``files`` parts of equally many files; returns the files of a part."""
    each = files_for(rows, files)
    df.repartition(files * each, "seq").write.parquet(path)  # by a key: dealing rows in turn sorts them first
    return each


def write_events(spark: SparkSession, sf_dir: str, path: str, files: int) -> int:
    """``write_shuffled`` of ``events_changelog``: rows of the table are shuffled, not the wider changes, which the
    tasks that write the files make; whoever reads the table does little, be it one task."""
    each = files_for(rows_of(spark, sf_dir, "events"), files)
    events_changelog(spark, sf_dir, files * each).write.parquet(path)
    return each


def write_feed(lines: DataFrame, path: str, files: int = 4, rows: int = 0) -> int:
    """As ``write_shuffled``, a feed of serialized entries as text files."""
    each = files_for(rows, files)
    lines.select("value").repartition(files * each).write.text(path)
    return each


def write_in_time_order(df: DataFrame, path: str, chunk_days: int = 6, files: int = 1) -> int:
    """Land a stand-in log in chunks of ``chunk_days`` of event time, in time order; returns the files of a chunk."""
    day = F.date_diff(F.col("exec_time"), F.lit(df.select(F.to_date(F.min("exec_time"))).first()[0]))
    return _land(df, F.floor(day / F.lit(chunk_days)).cast("int"), path, files)


def write_in_seq_order(df: DataFrame, path: str, chunks: int = 5, files: int = 1) -> int:
    """Land a stand-in log in ``chunks`` consecutive ``seq`` ranges, in ``seq`` order; returns the files of a chunk."""
    lo, hi = df.agg(F.coalesce(F.min("seq"), F.lit(0)), F.coalesce(F.max("seq"), F.lit(0))).first()
    width = F.lit((hi - lo) // chunks + 1)
    return _land(df, F.floor((F.col("seq") - F.lit(lo)) / width).cast("int"), path, files)


def multirow_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON entries that carry many rows each: the events of one type and 8000
    consecutive ids are one INSERT entry, rows in id order."""
    e = table(spark, sf_dir, "events").withColumn("block", F.expr("event_id div 8000"))
    after = image(cell("event_id", F.col("event_id"), key=True), cell("event_type", F.col("event_type")), cell("props", F.col("props")))
    rows = e.groupBy("event_type", "block").agg(
        F.min("event_id").alias("at"), F.min("ts").alias("ts"),
        F.sort_array(F.collect_list(F.struct("event_id", _empty().alias("before"), after.alias("after")))).alias("r"))
    kinds = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])
    return rows.select(F.to_json(F.struct(
        F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("event_type"), F.lit("app").alias("database"), F.lit("users").alias("table"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("execute_time"), F.lit(0).cast("long").alias("log_file"),
        (F.col("at") * 8 + F.array_position(kinds, F.col("event_type"))).alias("offset"), F.lit(None).cast("string").alias("ddl"),
        F.transform("r", lambda x: F.struct(x["before"].alias("before"), x["after"].alias("after"))).alias("rows"))).alias("value"))


BROKEN = [
    ('{"entry_type": @', "not JSON"),
    ('{"offset": @}', "no entry type"),
    ('{"entry_type": "ROWDATA", "offset": @}', "no event type"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "database": "app", "table": "users", "offset": @, "rows": "oops"}', "rows are no list of images"),
    ('{"entry_type": "ROWDATA", "event_type": "DELETE", "database": "app", "table": "users", "offset": @, "rows": []}', "no rows"),
    ('{"entry_type": "ROWDATA", "event_type": "UPDATE", "database": "app", "table": "users", "offset": @, "rows": [{"other": 1}]}', "a row without images"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "table": "users", "offset": @, "rows": [{"after": []}]}', "no database"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "database": "app", "offset": @, "rows": [{"after": []}]}', "no table"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "database": "app", "table": "users", "log_file": 99999, "offset": @, "rows": [{"after": []}]}', "out of range"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "database": "app", "table": "users", "offset": "x@", "rows": [{"after": []}]}', "a number is none"),
    ('{"entry_type": "ROWDATA", "event_type": "INSERT", "database": "app", "table": "users", "rows": [{"before": [@]}]}', "no offset"),
]


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no entries, in turn of ``BROKEN``, with an event id for the ``@``."""
    e = table(spark, sf_dir, "events").where("event_id % 50 = 7")
    form = F.element_at(F.array(*[F.lit(b) for b, _ in BROKEN]), F.expr(f"cast((event_id div 50) % {len(BROKEN)} + 1 as int)"))
    return e.select(F.replace(form, F.lit("@"), F.col("event_id").cast("string")).alias("value"))


def orders_ddl(spark: SparkSession, sf_dir: str, ddl: str, op: str = "ALTER") -> DataFrame:
    """One schema event of ``shop.orders`` at the place of ``orders_truncate_event``."""
    return orders_truncate_event(spark, sf_dir).withColumn("op", F.lit(op)).withColumn("ddl", F.lit(ddl))


def orders_after(spark: SparkSession, sf_dir: str, source: str = ORDERS_SOURCE, key: str = "o_orderkey") -> DataFrame:
    """The orders change log with the changes after that place under another
    source, or with another column flagged as their key."""
    at = table(spark, sf_dir, "orders").select(F.floor(F.max("o_orderkey") / 2) * 10 + 5).scalar()
    late = F.col("seq") > at

    def keyed(image_col: str) -> Column:
        return F.when(late, F.transform(image_col, lambda c: c.withField("is_key", c["name"] == key))).otherwise(F.col(image_col))

    log = orders_changelog(spark, sf_dir).withColumn("before", keyed("before")).withColumn("after", keyed("after"))
    return log.withColumn("source_key", F.when(late, source).otherwise(F.col("source_key"))).withColumn("table", F.substring_index("source_key", ".", -1))


# Key columns of each generation of a source of ``orders_keys_changelog``.
GENERATION_KEYS = [["o_orderkey"], ["o_custkey"], ["o_custkey", "o_orderdate"], ["o_orderkey"]]


def orders_keys_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders change log dealt to 20 sources ``shop.orders_00`` to ``_19`` by customer, with 50 key changes:
    every source changes its key at a quarter and a half of the log, even ones at three quarters too.  Changes
    after a key change carry its columns as key flags."""
    source = F.concat(F.lit("shop.orders_"), F.lpad(F.pmod(F.col("o_custkey"), F.lit(20)).cast("string"), 2, "0"))
    top = table(spark, sf_dir, "orders").select(F.max("o_orderkey")).scalar()
    times = [(F.floor(top * i / 4) * 10 + 5).cast("long") for i in (1, 2, 3)]
    log = orders_changelog(spark, sf_dir)
    customer = F.filter(F.coalesce("after", "before"), lambda c: c["name"] == "o_custkey")[0]["value"]
    log = log.withColumn("o_custkey", customer.cast("long")).withColumn("source_key", source)
    even = F.pmod("o_custkey", F.lit(2)) == 0
    generation = (F.col("seq") > times[0]).cast("int") + (F.col("seq") > times[1]).cast("int") + (even & (F.col("seq") > times[2])).cast("int")
    keys = F.element_at(F.array(*[F.array(*map(F.lit, k)) for k in GENERATION_KEYS]), generation + 1)
    flagged = {c: F.transform(c, lambda x: x.withField("is_key", F.array_contains("keys", x["name"]))) for c in ("before", "after")}
    log = log.withColumn("keys", keys).withColumns(flagged).withColumn("table", F.substring_index("source_key", ".", -1))
    events = spark.range(20).select(F.col("id").alias("o_custkey"), F.explode(F.array(*[F.struct(t.alias("seq"), F.lit(i + 1).alias("i")) for i, t in enumerate(times)])).alias("e"))
    events = events.where("e.i < 3 or o_custkey % 2 = 0").withColumn("source_key", source)
    named = F.element_at(F.array(*[F.lit(", ".join(k)) for k in GENERATION_KEYS]), F.col("e.i") + 1)
    events = events.select(
        "source_key", F.lit("shop").alias("database"), F.substring_index("source_key", ".", -1).alias("table"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("exec_time"), F.lit("ALTER").alias("op"),
        F.concat(F.lit("alter table "), F.substring_index("source_key", ".", -1), F.lit(" drop primary key, add primary key ("), named, F.lit(")")).alias("ddl"),
        F.col("e.seq").alias("seq"), _empty().alias("before"), _empty().alias("after"))
    return log.select(*CHANGELOG_COLUMNS).unionByName(events)


def swapped_sources_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of even and odd customers as two sources whose names are swapped by one RENAME statement in the
    middle of the log; one of the names had belonged to a table that was dropped before."""
    at = orders_truncate_event(spark, sf_dir)
    top = at.select(F.max("seq")).scalar()
    customer = F.filter(F.coalesce("after", "before"), lambda c: c["name"] == "o_custkey")[0]["value"].cast("long")
    log = orders_changelog(spark, sf_dir)
    first = F.pmod(customer, F.lit(2)) == 0
    late = F.col("seq") > top
    name = F.when(first != late, "shop.even").otherwise("shop.odd")
    log = log.withColumn("source_key", name).withColumn("table", F.substring_index("source_key", ".", -1))
    event = at.withColumn("op", F.lit("RENAME")).withColumn("ddl", F.lit("rename table even to tmp, odd to even, tmp to odd")).withColumn("source_key", F.lit("shop.even"))
    gone = at.withColumn("source_key", F.lit("shop.tmp")).withColumn("op", F.lit("ERASE")).withColumn("ddl", F.lit("drop table tmp")).withColumn("seq", F.col("seq") - 1)
    return log.unionByName(event).unionByName(gone)
