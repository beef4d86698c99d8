"""Merkle fixity audit of archive replicas.

An archive is files of records, each at a byte offset. Leaves are the SHA-256 digests of records. Level 0
hashes, in order, the records that begin in one range of ``LEAF_BYTES`` bytes of a file; every level above
hashes ``FANOUT`` neighbouring ranges, up to one root. A file spans a power of ``FANOUT`` ranges, so
files are subtrees. Two replicas with equal roots are equal. Otherwise the audit goes down, level by
level, only below nodes whose hashes differ, and compares records in the differing ranges alone.

A node has at most ``FANOUT`` children and a leaf range at most ``LEAF_BYTES`` divided by the smallest record,
so no group grows with the archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.llm.common import cut
from candor.plans.ordinals import global_row_number

LEAF_BYTES = 1 << 18
FANOUT = 16
FILE_RECORDS = 1000


def warc_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``page_id, h1, h2, record``: each page as a WARC record, with 128 bits that name the page by its content.

    NULL url and payload are written as empty. Other columns are ignored. No shuffle.
    """
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                       F.coalesce(F.col(payload), F.lit("")).alias("body"))
    record = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), "url", F.lit("\r\nContent-Length: "),
                      F.octet_length("body").cast("string"), F.lit("\r\n\r\n"), "body", F.lit("\r\n\r\n"))
    return own.select("page_id", F.xxhash64("page_id", "url", "body").alias("h1"), F.xxhash64("body", "url", "page_id", F.lit("row")).alias("h2"),
                      record.alias("record"))


def archive(records: DataFrame) -> DataFrame:
    """The manifest of ``records(page_id, h1, h2, record)``: ``page_id, h1, h2, copy, file_no, offset, length, digest``.

    Records stand in ``page_id`` order (NULL last, equal ids by content, repeated rows side by side), in files of
    ``FILE_RECORDS``. Only lengths and digests are shuffled, never a record.
    """
    rows = records.groupBy("page_id", "h1", "h2", *_measured("record")).agg(F.count(F.lit(1)).alias("copies"))
    each = rows.select("page_id", "h1", "h2", "length", "digest", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return _filed(each)


def _filed(each: DataFrame) -> DataFrame:
    """Records in order, in files of ``FILE_RECORDS`` from 0, each at the sum of the lengths before it."""
    ranked = global_row_number(each, [F.col("page_id").asc_nulls_last(), F.col("h1").asc(), F.col("h2").asc(), F.col("copy").asc()], "rn")
    w = Window.partitionBy("file_no").orderBy("rn").rowsBetween(Window.unboundedPreceding, -1)  # at most FILE_RECORDS rows
    filed = ranked.withColumn("file_no", F.floor((F.col("rn") - 1) / FILE_RECORDS))
    return filed.select("page_id", "h1", "h2", "copy", "file_no", F.coalesce(F.sum("length").over(w), F.lit(0)).alias("offset"), "length", "digest")


def replica(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """What a replica holds: its ``records(page_id, h1, h2, record)`` measured anew, ``page_id, file_no, offset, length, digest``.

    Each record takes the manifest's place of the record that its name (``h1, h2``) says it is; the copies of one name take places in
    order, so a lost copy leaves a place empty. A lost or shortened record does not move those behind it. Records without a place (a name that the manifest
    lacks, or more copies than it has) stand in files of their own after the manifest's last one. (Replicas whose records carry
    their own places are compared by ``digests``.)
    """
    held = records.groupBy("h1", "h2", *_measured("record")).agg(F.min("page_id").alias("own_id"), F.count(F.lit(1)).alias("copies"))
    w = Window.partitionBy("h1", "h2").orderBy("length", "digest").rowsBetween(Window.unboundedPreceding, -1)  # a name's different contents
    before = held.withColumn("before", F.coalesce(F.sum("copies").over(w), F.lit(0)))
    each = before.select("h1", "h2", "length", "digest", "own_id", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("copies"))).alias("copy"))
    placed = cut(each.join(manifest.select("page_id", "h1", "h2", "copy", "file_no", "offset"), ["h1", "h2", "copy"], "left"))
    columns = ["page_id", "file_no", "offset", "length", "digest"]
    found = placed.where("file_no is not null").select(*columns)
    after = (manifest.agg(F.max("file_no")).first()[0] if not manifest.isEmpty() else -1) + 1
    extra = _filed(placed.where("file_no is null").select(F.col("own_id").alias("page_id"), "h1", "h2", "copy", "length", "digest"))
    return found.unionByName(extra.withColumn("file_no", F.col("file_no") + after).select(*columns))


def _measured(record: str) -> list[Column]:
    return [F.octet_length(record).cast("long").alias("length"), F.unhex(F.sha2(record, 256)).alias("digest")]


def digests(records: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, file_no, offset, length, digest`` of records that carry their place; rows without a place are left out."""
    return records.where("file_no is not null and offset is not null and record is not null").select(
        key, F.col("file_no").cast("long").alias("file_no"), F.col("offset").cast("long").alias("offset"), *_measured("record"))


def _hashed(parts: str, fields: list[str]) -> Column:
    """SHA-256 over the ordered members of a node."""
    text = F.transform(F.sort_array(parts), lambda x: F.concat_ws(":", *[x[f].cast("string") if f != "digest" else F.hex(x[f]) for f in fields]))
    return F.unhex(F.sha2(F.array_join(text, ","), 256))


def tree(leaves: DataFrame, file_ranges: int, levels: int) -> list[DataFrame]:
    """Levels ``(node, digest)`` from the offset ranges up to the root."""
    node = (F.col("file_no") * file_ranges + F.floor(F.col("offset") / LEAF_BYTES)).cast("long")
    level = leaves.groupBy(node.alias("node")).agg(F.collect_list(F.struct("offset", "length", "digest")).alias("m")).select(
        "node", _hashed("m", ["offset", "length", "digest"]).alias("digest"))
    out = [cut(level)]
    for _ in range(levels):
        below = out[-1]
        out.append(below.groupBy(F.floor(F.col("node") / FANOUT).alias("up")).agg(F.collect_list(F.struct("node", "digest")).alias("m")).select(
            F.col("up").alias("node"), _hashed("m", ["node", "digest"]).alias("digest")))
    return out


def differing(a: DataFrame, b: DataFrame, within: DataFrame | None) -> DataFrame:
    """Nodes of one level whose digests differ, among children of ``within(node)``."""
    if within is not None:
        up = within.select(F.col("node").alias("up"))
        a, b = (x.withColumn("up", F.floor(F.col("node") / FANOUT)).join(up, "up", "left_semi").drop("up") for x in (a, b))
    other = b.select("node", F.col("digest").alias("theirs"))
    return a.join(other, "node", "full").where(~F.col("digest").eqNullSafe(F.col("theirs"))).select("node")


def audit(ours: DataFrame, theirs: DataFrame, key: str = "page_id") -> DataFrame:
    """Where two replicas differ: ``key, file_no, offset, length, replica_length, status``.

    Both are ``(key, file_no, offset, length, digest)``, as ``archive``, ``replica`` or ``digests`` give. ``status`` is ``missing`` (only in ``ours``), ``extra`` (only in
    ``theirs``), ``truncated`` (shorter there) or ``changed``. Records at one place several times are compared as the
    ordered list of them. Equal replicas, two empty ones included, give no rows.
    """
    a, b = (cut(x.select(key, "file_no", "offset", "length", "digest")) for x in (ours, theirs))
    top = a.select("file_no", "offset").unionByName(b.select("file_no", "offset")).agg(F.max("file_no"), F.max("offset")).first()
    if top[0] is None:
        files = file_ranges = levels = 1
    else:
        file_ranges = 1
        while file_ranges * LEAF_BYTES <= top[1]:
            file_ranges *= FANOUT
        files, levels = top[0] + 1, 0
        while FANOUT ** levels < files * file_ranges:
            levels += 1
    tree_a, tree_b = tree(a, file_ranges, levels), tree(b, file_ranges, levels)
    bad = None
    for level_a, level_b in zip(reversed(tree_a), reversed(tree_b)):
        bad = cut(differing(level_a, level_b, bad))
        if bad.isEmpty():
            break
    node = (F.col("file_no") * file_ranges + F.floor(F.col("offset") / LEAF_BYTES)).cast("long")

    def suspects(x: DataFrame) -> DataFrame:
        kept = x.withColumn("node", node).join(bad, "node", "left_semi")
        return kept.groupBy("file_no", "offset").agg(F.min(key).alias(key), F.sort_array(F.collect_list(F.struct("length", "digest"))).alias("m"))

    p = suspects(a).select("file_no", "offset", F.col(key).alias("k"), F.col("m").alias("ma"))
    q = suspects(b).select("file_no", "offset", F.col(key).alias("l"), F.col("m").alias("mb"))
    both = p.join(q, ["file_no", "offset"], "full").where(~F.col("ma").eqNullSafe(F.col("mb")))
    total = {c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda s, x: s + x["length"]) for c in ("ma", "mb")}
    status = (F.when(F.col("mb").isNull(), "missing").when(F.col("ma").isNull(), "extra")
              .when(total["mb"] < total["ma"], "truncated").otherwise("changed"))
    return both.select(F.coalesce("k", "l").alias(key), "file_no", "offset", total["ma"].alias("length"), total["mb"].alias("replica_length"), status.alias("status"))


def damaged_replica(records: DataFrame, key: str = "page_id") -> DataFrame:
    """A copy of ``records`` with damage chosen by the key's MD5: its first two hex digits 00 or 01 change a
    byte, 02 loses the record, 03 cuts its last 40 characters, 04 adds a record of another name. Only for audits of tables that have one replica."""
    pick = F.substring(F.md5(F.col(key).cast("string")), 1, 2)
    record = (F.when(pick.isin("00", "01"), F.concat(F.expr("left(record, length(record) - 5)"), F.lit("~"), F.expr("right(record, 4)")))
              .when(pick == "03", F.expr("left(record, length(record) - 40)")).otherwise(F.col("record")))
    kept = records.where(F.coalesce(pick != "02", F.lit(True))).withColumn("record", record)
    names = {h: F.xxhash64(h, F.lit("extra")) for h in ("h1", "h2")}
    return kept.unionByName(records.where(pick == "04").withColumns({**names, "record": F.concat(F.lit("X"), "record")}))
