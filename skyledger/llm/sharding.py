"""Sharding by a permutation-filled lookup table.

Every shard ranks the slots of a prime-sized table by a permutation of its own, (offset + j * skip) mod size.
The shards then take turns: each claims the first slot of its ranking that is still free, until none is. A
document's slot is a digest of its id modulo the size, so it is placed by one array access; when a shard is
added or leaves, few slots change hands. A shard may have a weight: the number of claims in each round.

Results for special input: a null id is placed as the text 'null' would be; repeated rows are placed alike;
an empty table gives an empty result; a very long key is digested whole; a table that has a column named like the slot's or
the shard's is an error (give other names), as neither may replace the other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import column, table, unused

#: Production parameters: names of the shards, and a prime of more than a hundred slots for each of them.
SHARDS = tuple(f"shard-{k:02d}" for k in range(32))
TABLE_SIZE = 4099
#: The lookup table goes into the plan as one constant array; so many slots (4 bytes each) at most.
MAX_SLOTS = 1_000_003


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, weights: tuple[int, ...] | None = None) -> list[int]:
    """For each slot the index of its shard. `size` is a prime of at least the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not len(shards) <= size <= MAX_SLOTS or size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"size must be a prime from the number of shards to {MAX_SLOTS}")
    turns = [1] * len(shards) if weights is None else list(weights)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("weights: one for each shard, none negative, one positive")
    offset = [_digest(f"offset:{x}") % size for x in shards]
    skip = [_digest(f"skip:{x}") % (size - 1) + 1 for x in shards]
    tried, owner, left = [0] * len(shards), [-1] * size, size
    while left:
        for k, claims in enumerate(turns):
            for _ in range(min(claims, left)):
                while owner[slot := (offset[k] + tried[k] * skip[k]) % size] >= 0:
                    tried[k] += 1
                owner[slot] = k
                left -= 1
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the first 60 bits of the MD5 of its text, modulo the size of the table."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size).cast("long"))


def place(docs: DataFrame, key_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, slot_as: str = "slot", shard_as: str = "shard") -> DataFrame:
    """`docs` with its slot and shard; no shuffle: the table is a constant of the plan, bounded by MAX_SLOTS."""
    if clash := {slot_as.lower(), shard_as.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has columns {sorted(clash)}: choose other names by slot_as and shard_as")
    owners = F.lit(lookup_table(shards, size))
    names = F.lit(list(shards))
    slot = slot_of(column(key_col), size)
    return docs.withColumns({slot_as: slot, shard_as: F.element_at(names, F.element_at(owners, slot.cast("int") + 1) + 1)})


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, files_per_shard: int = 8) -> None:
    """Write `docs` as Parquet, a folder for each shard; a shard's rows are dealt over several tasks by slot."""
    slot, shard = unused(docs.columns, "slot"), unused(docs.columns, "shard")
    placed = place(docs, key_col, shards, size, slot, shard)
    placed.repartition(len(shards) * files_per_shard, shard, F.pmod(F.col(slot), F.lit(files_per_shard))).write.partitionBy(shard).parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id"))


def op10_sql() -> str:
    """Slots by the same digest; shards from a plain list of the table that the rules above give."""
    owners = ", ".join(map(str, lookup_table()))
    names = ", ".join(f"'{x}'" for x in SHARDS)
    return f"""
WITH t AS (SELECT [{owners}] AS owners, [{names}] AS names),
d AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)) AS BIGINT) % {TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, slot, names[owners[CAST(slot AS INT) + 1] + 1] AS shard FROM d, t
"""
