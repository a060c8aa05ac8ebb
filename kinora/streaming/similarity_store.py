"""Similarity tables that micro-batches join without moving them, replaced as a whole by version.

The pairs are bucketed and sorted by source, the members once by movie and once by source, so a join or ranking on those
columns finds them dealt out already: only the rows of the micro-batch move.  A new version is written beside the old one; a
manifest names the version that counts (see ``versions``), so a reader has all of one or all of the other.

Joins on (source, target) use the buckets of source only where ``spark.sql.requireAllClusterKeysForCoPartition`` is off.  That
is a choice of the session that serves micro-batches: in others it would let a hot first key decide where rows go.
"""

import uuid

from kinora.operators.similar import ItemSimilarity
from kinora.streaming import versions

BUCKETS = 64
#: Parts of a store: their bucket column.
_PARTS = {"pairs": "source", "members": "mid", "groups": "source"}


def publish(similarity, path, buckets=BUCKETS):
    """Write a version of an :class:`ItemSimilarity` and make it the one that counts."""
    spark = similarity.pairs.sparkSession
    version = uuid.uuid4().hex
    frames = {"pairs": similarity.pairs}
    if similarity.members is not None:
        frames |= {"members": similarity.members, "groups": similarity.members}
    tables = {}
    for part, frame in frames.items():
        name, column = f"kinora_{part}_{version}", _PARTS[part]
        where = f"{path}/{version}/{part}"
        # Dealt out before the write: one file a bucket.
        writer = frame.repartition(buckets, column).write.format("parquet").bucketBy(buckets, column).sortBy(column)
        writer.option("path", where).saveAsTable(name)
        tables[part] = {"table": name, "path": where, "buckets": buckets, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)}
    versions.publish(spark, path, lambda content: {"tables": tables})
    return tables


def _table(spark, part, about):
    """A part as a bucketed table; sessions that have not written it take it up from its files."""
    if not spark.catalog.tableExists(about["table"]):
        column = _PARTS[part]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {about['table']} ({about['schema']}) USING parquet "
            f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {about['buckets']} BUCKETS LOCATION '{about['path']}'"
        )
    return spark.table(about["table"])


def current(spark, path):
    """The version that counts, as an :class:`ItemSimilarity`."""
    content = versions.manifest(spark, path)[1]
    if content is None:
        raise FileNotFoundError(path)
    parts = {part: _table(spark, part, about) for part, about in content["tables"].items()}
    return ItemSimilarity(parts["pairs"], parts.get("members"), groups=parts.get("groups"))
