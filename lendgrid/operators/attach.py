"""Many look-ups attached to a wide table in a fixed number of shuffles.

A chain of left joins on different keys shuffles the wide driving rows at every
change of key, and one more frame for each look-up. ``attach_many`` resolves the look-ups
on narrow rows instead: a driving row asks with one row for each of its keys, all looked-up
frames are tagged and put together into one, questions and answers meet on
(tag, key), one aggregate gathers the answers of a driving row into a value for each
look-up, and the driving rows are joined with that once. Whatever the number of
look-ups, that is five shuffles, of which one moves wide rows. Driving rows that are
written first (``materialize``) carry a number: four shuffles, and far less to move.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendgrid.session import ensure_checkpoint_dir

#: Prefix of the columns that exist only inside this operator.
OWN = "__attach_"
#: Spark's setting by which a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Types whose values are the same where their texts are.
EXACT = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.BooleanType)


@dataclass(frozen=True)
class Lookup:
    """The rows of ``frame`` whose columns ``on`` equal the driving row's ``keys``; all columns
    of the frame are attached. ``unique`` says that the frame has one row a key by the way it is
    made; others multiply driving rows where a key is there twice, as a left join does."""

    frame: DataFrame
    on: Sequence[str]
    keys: Sequence[Column | str]
    unique: bool = field(default=False)


@dataclass(frozen=True)
class KeyCheck:
    """Duplicate keys observed while look-ups were attached."""

    observation: Observation
    keys: tuple[str, ...]

    def duplicates(self) -> dict[str, int]:
        """Key columns of a look-up -> driving keys that had several rows (those without any are left out)."""
        counts = self.observation.get
        return {key: int(counts[f"n{k}"]) for k, key in enumerate(self.keys) if counts[f"n{k}"]}


def _columns(keys: Sequence[Column | str]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, each row with a number of its own.

    Shuffle files of the writing job are removed with it, so that they do not lie on the disk beside those of the next."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/attach-{uuid.uuid4().hex}"
    stored = df.select(F.monotonically_increasing_id().alias(f"{OWN}id"), *[F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() != "void"])
    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        stored.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, kept) if kept else spark.conf.unset(CLEANUP)
    read = spark.read.schema(stored.schema).parquet(path)
    return read.select(f"{OWN}id", *[F.lit(None).alias(f.name) if f.dataType.typeName() == "void" else F.col(f"`{f.name}`") for f in df.schema])


def key_text(keys: Sequence[Column]) -> Column:
    """The keys as one text, NULL if any of them is (it equals nothing)."""
    texts = [k.cast("string") for k in keys]
    if len(texts) == 1:
        return texts[0]
    known = texts[0].isNotNull()
    for t in texts[1:]:
        known = known & t.isNotNull()
    return F.when(known, F.to_json(F.array(*texts)))


def attach_many(driving: DataFrame, lookups: Sequence[Lookup], row_key: Sequence[Column | str] = (), materialize: bool = False,
                checks: list[KeyCheck] | None = None) -> DataFrame:
    """``driving`` with the columns of every look-up's frame, as left joins in a row would
    give them: NULL keys and keys without a row get NULLs, a key with several rows
    multiplies the driving row.

    Keys of the same text (column expression) ask once. ``row_key`` names columns that tell
    driving rows apart; it only spreads the rows, so that many rows with the same keys do not
    meet in one task. Rows without any key take part in no look-up, and a key that many rows ask
    for is one partition of narrow rows, which adaptive execution splits.

    The driving rows are read twice (for their questions and for the join), so a driving frame
    that is a join tree itself is to be computed once: with ``materialize`` it is written to the
    shared folder first, each row with a number. The numbers stand for the rows in questions and
    answers, where otherwise a digest of ``row_key`` and the keys does, which takes more disk and one
    shuffle more (rows with the same digest ask once). Large inputs are to be given so. Look-ups whose keys come from others go into a second call.

    ``checks`` gets a :class:`KeyCheck`, which knows after the next action on the result how
    many driving rows met several rows of a look-up; it is counted in the aggregate that runs anyway.
    """
    columns = driving.columns
    asked = [_columns(x.keys) for x in lookups]
    types = driving.select(*[c.alias(f"{OWN}{i}_{j}") for i, keys in enumerate(asked) for j, c in enumerate(keys)]).schema
    for i, x in enumerate(lookups):
        for j, name in enumerate(x.on):
            ours, theirs = types[f"{OWN}{i}_{j}"].dataType, x.frame.schema[name].dataType
            if ours != theirs:
                raise TypeError(f"look-up {i}: key {name} is {theirs.simpleString()}, asked with {ours.simpleString()}; cast one of them")
    taken = set(columns)
    for x in lookups:
        if clash := taken & set(x.frame.columns):
            raise ValueError(f"columns attached twice: {sorted(clash)}")
        taken |= set(x.frame.columns)

    if materialize:
        driving = written(driving)
    # One question for each different key expression.
    names = [str(keys) for keys in asked]
    tags = {name: tag for tag, name in enumerate(dict.fromkeys(names))}
    texts = {tags[name]: key_text(keys) for name, keys in zip(names, asked)}
    ask = [f"{OWN}k{tag}" for tag in texts]
    keyed = driving.select("*", *[text.alias(f"{OWN}k{tag}") for tag, text in texts.items()])
    some = F.coalesce(*ask).isNotNull()
    asking = keyed.where(some)
    if not materialize:
        row = F.unhex(F.md5(F.to_json(F.array(*[c.cast("string") for c in _columns(row_key)], *[F.col(c) for c in ask]))))
        # Rows that ask for nothing get an id that no answer has, each its own, so that they spread.
        alone = F.concat(F.lit("-"), F.xxhash64(*(_columns(row_key) or [F.col(c) for c in columns])).cast("string")).cast("binary")
        keyed = keyed.withColumn(f"{OWN}id", F.when(some, row).otherwise(alone))
        asking = keyed.where(some).select(f"{OWN}id", *ask).distinct()

    questions = (asking
                 .select(f"{OWN}id", F.explode(F.array(*[F.struct(F.lit(tag).alias("tag"), F.col(f"{OWN}k{tag}").alias("key")) for tag in texts])).alias("q"))
                 .select(f"{OWN}id", "q.tag", "q.key").where(F.col("key").isNotNull()))
    # Answers leave out their keys, which the driving row has.
    known = [{c: key for c, key in zip(x.on, keys) if isinstance(t := x.frame.schema[c].dataType, EXACT) and "collate" not in t.simpleString()}
             for x, keys in zip(lookups, asked)]
    known = [keys if set(x.frame.columns) - set(keys) else {} for x, keys in zip(lookups, known)]
    told = [[c for c in x.frame.columns if c not in keys] for x, keys in zip(lookups, known)]
    answers = None
    for i, (x, name) in enumerate(zip(lookups, names)):
        text = key_text([F.col(c) for c in x.on])
        empty = [F.lit(None).cast(y.frame.select(*told[k]).schema).alias(f"{OWN}v{k}") for k, y in enumerate(lookups)]
        empty[i] = F.struct(*told[i]).alias(f"{OWN}v{i}")
        own = x.frame.where(text.isNotNull()).select(F.lit(tags[name]).alias("tag"), text.alias("key"), *empty)
        answers = own if answers is None else answers.union(own)
    # Answers are dealt as they are: those of a row come from different places, so that gathering some before makes them larger only.
    gathered = questions.join(answers, ["tag", "key"]).drop("tag", "key").repartition(f"{OWN}id").groupBy(f"{OWN}id").agg(
        *[(F.first(f"{OWN}v{i}", ignorenulls=True) if x.unique else F.collect_list(f"{OWN}v{i}")).alias(f"{OWN}v{i}") for i, x in enumerate(lookups)])
    out = keyed.drop(*ask).join(gathered, f"{OWN}id", "left").drop(f"{OWN}id")
    several = [i for i, x in enumerate(lookups) if not x.unique]
    if checks is not None and several:
        check = KeyCheck(Observation(), tuple(", ".join(lookups[i].on) for i in several))
        # on the joined rows, which no optimisation can leave out
        out = out.observe(check.observation, *[F.count_if(F.size(f"{OWN}v{i}") > 1).alias(f"n{k}") for k, i in enumerate(several)])
        checks.append(check)
    for i, x in enumerate(lookups):
        if not x.unique:
            out = out.withColumn(f"{OWN}v{i}", F.explode_outer(f"{OWN}v{i}"))
    return out.select(*columns, *[(F.when(F.col(f"{OWN}v{i}").isNotNull(), known[i][c]) if c in known[i] else F.col(f"{OWN}v{i}.{c}")).alias(c)
                                  for i, x in enumerate(lookups) for c in x.frame.columns])
