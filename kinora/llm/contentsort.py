"""Exact duplicates by a content sort.

1. Every scan task sorts its own rows by content and compares neighbours in full: equal texts of a task become one run,
   headed by the row that stays.  Only heads go on, so a text that makes up a third of all rows leaves each task once.
2. Heads are dealt to ranges of the sort key, whose splitters Spark samples, and sorted there externally.  The key is the
   text's leading bytes, then its SHA-256: splitters stay short whatever the texts, and texts that share a long beginning
   still spread.  Neighbours are compared in full again; the first of a group of equals is the row that stays.
3. A text that heads runs in very many tasks is dealt to several sorts by a salt first, and their winners meet in a second
   sort.  Both ways give the same groups.
4. Rows find their group by their run.  A run is part of one task, so no join key is hot.

Of equal texts the row with the smallest key stays (``keep="largest"``: the largest).

Defined cases: a null text equals an empty one; a null key never stays beside another key; of rows that repeat a key and its
text one stays; rows with null keys alone are a group like any other, of which one stays; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kinora.llm.common import partitions, stored

#: Leading bytes of the sort key.
LEAD = 16
#: Runs of one text that a range may hold; with very many runs their 100,000th part.
HEAVY = 1_000
MOST_HEAVY = 100_000
SALTS = 64

RUNS = "doc_id long, at long, run long, sha binary, lead binary, text string, n long"
MERGED = "run long, first long, keep_id long, keep_at long, size long, salted boolean, sha binary, lead binary, text string"


def _neighbours(arrow):
    """Each batch of sorted rows with flags: the row's text differs from the one before, across batches too."""
    last = None
    for batch in arrow:
        if not batch.num_rows:
            continue
        text = batch.column("text")
        new = np.ones(len(text), bool)
        new[0] = last is None or text[0].as_py() != last
        new[1:] = pc.not_equal(text.slice(1), text.slice(0, len(text) - 1)).to_numpy(zero_copy_only=False)
        last = text[len(text) - 1].as_py()
        yield batch, new


def _batch(columns, schema):
    arrays = [columns.get(f.name, pa.nulls(len(columns["run"]), f.type)) for f in schema]
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)


def _runs(schema):
    """Rows of a task, sorted -> one row per row (its place ``at`` and run), and one per run (with ``n`` rows and the text)."""

    def run(arrow):
        at, rows, head = TaskContext.get().partitionId() << 40, 0, None  # head of the run that is still open
        for batch, new in _neighbours(arrow):
            places = at + np.arange(batch.num_rows)
            at += batch.num_rows
            starts = np.flatnonzero(new)
            lengths = np.diff(np.concatenate([[0], starts, [batch.num_rows]]))
            names = np.concatenate([[head["run"][0] if head else 0], places[starts]])
            yield _batch(
                {"doc_id": batch.column("doc_id"), "at": places, "run": np.repeat(names, lengths), "sha": batch.column("sha")}
                | ({"row": batch.column("row")} if "row" in batch.schema.names else {}),
                schema,
            )
            rows += int(lengths[0])
            if not len(starts):
                continue
            if head:
                yield _batch(head | {"n": [rows]}, schema)
            if len(starts) > 1:
                yield _batch(_heads(batch, places, starts[:-1]) | {"n": lengths[1:-1]}, schema)
            head, rows = _heads(batch, places, starts[-1:]), int(lengths[-1])
        if head:
            yield _batch(head | {"n": [rows]}, schema)

    return run


def _heads(batch, places, at):
    part = batch.select(["doc_id", "sha", "lead", "text"]).take(pa.array(at))
    return {name: part.column(name) for name in part.schema.names} | {"at": places[at], "run": places[at]}


def _merge(schema):
    """Heads of a range, sorted -> their group's first run, row that stays and size; the text of a salted group's first."""

    def run(arrow):
        held, flags, last = None, None, -1
        for batch, new in _neighbours(arrow):
            salt = batch.column("salt").fill_null(-1).to_numpy()
            new |= np.diff(salt, prepend=last) != 0
            last = salt[-1]
            with_text = new & (salt >= 0)
            text = pc.if_else(pa.array(with_text), batch.column("text"), None)
            narrow = batch.set_column(batch.schema.get_field_index("text"), "text", text)
            if held is not None:
                narrow, new = pa.concat_batches([held, narrow]), np.concatenate([flags, new])
            starts = np.flatnonzero(new)
            if starts[-1]:
                yield grouped(narrow.slice(0, starts[-1]), starts[:-1])
            held = narrow.take(pa.array(np.arange(starts[-1], len(new))))
            flags = new[starts[-1] :]
        if held is not None:
            yield grouped(held, np.zeros(1, np.int64))

    def grouped(rows, starts):
        lengths = np.diff(np.append(starts, rows.num_rows))
        first = pa.array(np.repeat(starts, lengths))
        sizes = np.add.reduceat(rows.column("n").to_numpy(), starts)
        return _batch(
            {
                "run": rows.column("run"), "first": rows.column("run").take(first), "keep_id": rows.column("doc_id").take(first),
                "keep_at": rows.column("at").take(first), "size": np.repeat(sizes, lengths), "salted": rows.column("salt").is_valid(),
                "sha": rows.column("sha"), "lead": rows.column("lead"), "text": rows.column("text"),
            },
            schema,
        )

    return run


def _order(keep):
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    return F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()


def _sorted_groups(spark, heads, order):
    """One row per head: its group, by ranges of the sort key."""
    dealt = heads.repartitionByRange(partitions(spark), "lead", "sha", "salt").sortWithinPartitions("lead", "sha", "salt", "text", order, "at")
    schema = to_arrow_schema(StructType.fromDDL(MERGED))
    return dealt.select("doc_id", "at", "run", "sha", "lead", "text", "n", "salt").mapInArrow(_merge(schema), MERGED)


def _grouped(rows, keep, heavy):
    """``rows`` (doc_id, text and maybe row) as (doc_id, at, sha, [row], keep_id, keep_at, size)."""
    spark, order = rows.sparkSession, _order(keep)
    passed = [c for c in rows.columns if c == "row"]
    sha = F.unhex(F.sha2("text", 256))
    keyed = rows.select("doc_id", "text", F.substring(F.encode("text", "utf-8"), 1, LEAD).alias("lead"), sha.alias("sha"), *passed)
    local = keyed.sortWithinPartitions("lead", "sha", "text", order)
    wide = StructType.fromDDL(RUNS)
    for name in passed:
        wide.add(name, rows.schema[name].dataType, True)
    runs = stored(spark, local.mapInArrow(_runs(to_arrow_schema(wide)), wide), "runs")
    heads, members = runs.where("n is not null"), runs.where("n is null").select("doc_id", "at", "run", "sha", *passed)
    often = heads.groupBy("sha").agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > heavy)
    often = stored(spark, often, "often", files=8)
    if often.isEmpty():
        found = _sorted_groups(spark, heads.withColumn("salt", F.lit(None).cast("int")), order)
    else:
        # At most MOST_HEAVY texts have more runs than this: a list that may be sent to every task.
        most = max(heavy, heads.count() // MOST_HEAVY)
        listed = F.broadcast(often.where(F.col("runs") > most).select("sha", F.lit(True).alias("listed")))
        salt = F.when(F.col("listed"), F.pmod(F.xxhash64("run"), F.lit(SALTS)).cast("int"))
        salted = heads.join(listed, "sha", "left").withColumn("salt", salt)
        once = stored(spark, _sorted_groups(spark, salted, order), "salted")
        winners = once.where("text is not null").select(
            F.col("keep_id").alias("doc_id"), F.col("keep_at").alias("at"), "run", "sha", "lead", "text", F.col("size").alias("n"), F.lit(None).cast("int").alias("salt")
        )
        twice = _sorted_groups(spark, winners, order).select(F.col("run").alias("first"), "keep_id", "keep_at", "size")
        found = once.where("not salted").select("run", "keep_id", "keep_at", "size").unionByName(
            once.where("salted").select("run", "first").join(twice, "first").select("run", "keep_id", "keep_at", "size")
        )
    found = found.select("run", "keep_id", "keep_at", "size")
    return members.join(found, "run")


def _rows(docs, key, text, normal):
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), (normal(content) if normal else content).alias("text"))


def groups(docs, key="doc_id", text="text", keep="smallest", normal=None, heavy=HEAVY):
    """One row per row: doc_id, keep_id (key of the row that stays), group_size, kept, text_sha256.

    ``normal`` turns the text column into what is compared; by default it is the text as it is.
    """
    return _grouped(_rows(docs, key, text, normal), keep, heavy).select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("at") == F.col("keep_at")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs, key="doc_id", text="text", keep="smallest", normal=None, heavy=HEAVY):
    """``docs``, one row of each group of equal texts, all columns."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), (normal(content) if normal else content).alias("text"), whole)
    return _grouped(rows, keep, heavy).where("at = keep_at").select("row.*")
