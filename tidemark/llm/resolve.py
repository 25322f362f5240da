"""Variant spellings of the names of firms and persons, linked by merging and matching again.

Spellings that differ only in order, case, dots and legal forms start as one profile. Profiles meet in blocks: a
word less one character beside the first letter of another word, which two matching names always share. Profiles
that match are merged and keep all their spellings and acronyms, and the merged profiles match again, until nothing
merges. Whether two spellings can be one name does not depend on the profiles they stand in, so each pair of spellings is
compared once: a merge moves what was compared to the profile it now belongs to, and only that is judged anew. Acronyms
join the profile that states them ("ABC (formerly ...)", or the alias of a known firm), otherwise the only profile of such initials.

Work is done on distinct names. A block pairs spellings, never rows, and a key joins two words of a name, so a
popular word alone makes no block. A block of more than ``CROWDED`` spellings is split by the whole second word; spellings
that have only its first letter, of which there are few, meet all of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from tidemark.llm import names
from tidemark.operators.components import components
from tidemark.session import arrow, land

#: A block of more spellings than this is split by its second word. Both ways find the same pairs.
CROWDED = 400

_PROFILE = StructType([StructField("tokens", ArrayType(StringType())), StructField("acronym", StringType()), StructField("filler", BooleanType()), StructField("initials", StringType())])


def profile_of(name: Column | str) -> Column:
    """struct<tokens, acronym, filler, initials> of a name."""

    @arrow(_PROFILE)
    def profile(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for v in batch.to_pylist():
                tokens, acronym, _ = names.parts(v or "")
                initials = "".join(t[0] for t in tokens) if len(tokens) > 2 and all(len(t) > 1 for t in tokens) else ""
                out.append({"tokens": list(tokens), "acronym": acronym, "filler": v is None or names.is_filler(v) or not tokens, "initials": initials})
            yield pa.array(out, pa.struct([("tokens", pa.list_(pa.string())), ("acronym", pa.string()), ("filler", pa.bool_()), ("initials", pa.string())]))

    return profile(name)


def _keys(tokens: Column | str) -> Column:
    @arrow(ArrayType(StringType()))
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted(names.block_keys(tuple(v))) for v in batch.to_pylist()], pa.list_(pa.string()))

    return keys(tokens)


def _finer_keys(text: Column | str, key: Column | str) -> Column:
    """The finer keys of a spelling in a block; empty for one that meets the whole block."""

    @arrow(ArrayType(StringType()))
    def keys(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, blocks in batches:
            yield pa.array([sorted(names.finer_keys(tuple(t.split()), k)) for t, k in zip(texts.to_pylist(), blocks.to_pylist(), strict=True)], pa.list_(pa.string()))

    return keys(text, key)


_MATCH = StructType([StructField("same", BooleanType()), StructField("to_x", StringType()), StructField("to_y", StringType())])


def _compare(x: Column | str, y: Column | str) -> Column:
    """struct<same, to_x, to_y>: whether two spellings can be one name, and what each adds to the other."""

    @arrow(_MATCH)
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for u, v in zip(left.to_pylist(), right.to_pylist(), strict=True):
                u, v = tuple(u.split()), tuple(v.split())
                same = names.same_name(u, v)
                out.append({"same": same, "to_x": names.adds(u, v) if same else "", "to_y": names.adds(v, u) if same else ""})
            yield pa.array(out, pa.struct([("same", pa.bool_()), ("to_x", pa.string()), ("to_y", pa.string())]))

    return compare(x, y)


def _contradict(told: Column | str) -> Column:
    @arrow(BooleanType())
    def contradict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([names.contradict(v) for v in batch.to_pylist()], pa.bool_())

    return contradict(told)


def _spelling_pairs(state: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b, x, y, to_x, to_y): the spellings x of profile a and y of profile b that can be one name, each pair once, and what each adds to the other."""
    spelled = state.filter((F.size("tokens") > 1) | (F.length(F.element_at("tokens", 1)) > 4)).select("pid", "tokens", F.array_join("tokens", " ").alias("text")).distinct()
    blocked = land(spelled.select("pid", "text", F.explode(_keys("tokens")).alias("key")), "blocks")
    large = blocked.groupBy("key").count().filter(F.col("count") > crowded).select("key")
    split = land(blocked.join(large.hint("merge"), "key").select("pid", "text", "key", _finer_keys("text", "key").alias("finer")), "split")
    fine = blocked.join(large.hint("merge"), "key", "left_anti").unionByName(split.select("pid", "text", F.explode("finer").alias("key")))

    def met(left: DataFrame, right: DataFrame, on) -> DataFrame:
        l, r = left.alias("l"), right.hint("merge").alias("r")
        one = l.join(r, (F.col("l.key") == F.col("r.key")) & on)
        swapped = F.col("l.pid") > F.col("r.pid")
        of = lambda c: (F.when(swapped, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")), F.when(swapped, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")))
        return one.select(of("pid")[0].alias("a"), of("pid")[1].alias("b"), of("text")[0].alias("x"), of("text")[1].alias("y"))

    pairs = met(fine, fine, F.col("l.pid") < F.col("r.pid")).unionByName(met(split.filter(F.size("finer") == 0), split, F.col("l.pid") != F.col("r.pid"))).distinct()
    return land(pairs.select("a", "b", "x", "y", _compare("x", "y").alias("m")).filter("m.same").select("a", "b", "x", "y", "m.to_x", "m.to_y"), "compared")


def _match_spellings(compared: DataFrame) -> DataFrame:
    """(a, b): profiles of which some spelling matches some spelling of the other.

    A spelling that leaves a part open (no middle initial, a given name's letter only) and matches names that fill it
    differently could be any of them: it links none of those.
    """
    told = compared.select(F.col("x").alias("text"), F.col("to_x").alias("told")).unionByName(compared.select(F.col("y").alias("text"), F.col("to_y").alias("told"))).filter("told <> ''")
    open_ = land(told.groupBy("text").agg(F.collect_set("told").alias("told")).filter(F.size("told") > 1).filter(_contradict("told")).select("text"), "open")
    side = lambda c: open_.select(F.col("text").alias(c), F.lit(True).alias(f"open_{c}")).hint("merge")
    clear = compared.join(side("x"), "x", "left").join(side("y"), "y", "left")
    return clear.filter("not (open_x is not null and to_x <> '') and not (open_y is not null and to_y <> '')").select("a", "b").distinct()


def _match_acronyms(state: DataFrame) -> DataFrame:
    """(a, b): bare acronyms with the profile that states them or, failing that, the only one of such initials.

    A statement "ABC (formerly X Y)" itself goes to the only profile of the initials ABC, which begins with X Y.
    """
    has = state.filter(F.col("acronym") != "")
    bare = has.filter(F.size("tokens") == 1).select("acronym", F.col("pid").alias("b")).distinct()
    stated = has.filter(F.size("tokens") > 1).groupBy("acronym").agg(F.min("pid").alias("a"), F.max("pid").alias("top")).filter("a = top").drop("top")
    every_stated = has.filter(F.size("tokens") > 1).select("acronym").distinct()
    full = state.filter(F.col("initials") != "").select(F.col("initials").alias("acronym"), "pid", "tokens")
    only = full.groupBy("acronym").agg(F.min("pid").alias("a"), F.max("pid").alias("top")).filter("a = top").drop("top")
    by_statement = bare.join(stated, "acronym").select("a", "b")
    by_initials = bare.join(every_stated, "acronym", "left_anti").join(only, "acronym").select("a", "b")
    former = has.filter(F.size("tokens") > 1).select("acronym", F.col("pid").alias("b"), F.col("tokens").alias("old"))
    begins = former.join(full, "acronym").filter(F.slice("tokens", 1, F.size("old")) == F.col("old")).select(F.col("pid").alias("a"), "b")
    return by_statement.unionByName(by_initials).unionByName(begins).filter("a <> b").distinct()


def resolve(spellings: DataFrame, name: str, known: DataFrame | None = None, crowded: int = CROWDED) -> DataFrame:
    """(name, entity) for every distinct spelling that names somebody; ``entity`` is shared by the variants of one.

    ``known`` may give (name, alias) of a reference list: its rows take part, its spellings are not returned.
    Nulls, blanks and fillers have no row; an empty table gives none.
    """
    rows = spellings.select(F.col(name).alias("name")).filter("trim(name) <> ''").distinct().select("name", F.lit("").alias("alias"), F.lit(True).alias("ours"))
    if known is not None:
        rows = rows.unionByName(known.select("name", F.coalesce(F.lower("alias"), F.lit("")).alias("alias"), F.lit(False).alias("ours")).filter("name is not null"))
    p = rows.repartition("name").select("name", "alias", "ours", profile_of("name").alias("p")).filter("not p.filler")
    first = F.concat_ws(" ", F.array_sort("p.tokens"), F.when((F.size("p.tokens") > 1) & (F.col("p.acronym") != ""), F.concat(F.lit("= "), F.col("p.acronym"))))
    base = land(p.select("name", "ours", first.alias("pid"), "p.tokens", F.coalesce(F.nullif("p.acronym", F.lit("")), "alias").alias("acronym"), "p.initials"), "names")
    state = base.select("pid", "tokens", "acronym", "initials").distinct()
    owner = base.select("pid").distinct().withColumn("entity", F.col("pid"))
    compared = _spelling_pairs(state, crowded)
    turn = 0
    while True:  # each turn but the first merges two profiles at least, so it ends
        links = _match_spellings(compared)
        merged = components(links if turn == 0 else links.unionByName(_match_acronyms(state)))
        if turn and merged.isEmpty():
            break
        move = merged.select(F.col("node").alias("pid"), "root").hint("merge")
        state = land(state.join(move, "pid", "left").select(F.coalesce("root", "pid").alias("pid"), "tokens", "acronym", "initials").distinct(), "profiles")
        owner = land(owner.join(move.withColumnRenamed("pid", "entity"), "entity", "left").select("pid", F.coalesce("root", "entity").alias("entity")), "owners")
        for side in ("a", "b"):
            compared = compared.join(move.select(F.col("pid").alias(side), F.col("root").alias(f"root_{side}")), side, "left").withColumn(side, F.coalesce(f"root_{side}", side)).drop(f"root_{side}")
        compared = land(compared.filter("a <> b"), "compared")
        turn += 1
    return base.filter("ours").select("name", "pid").join(owner.hint("merge"), "pid").select("name", "entity").distinct()


def pairs(resolved: DataFrame) -> DataFrame:
    """(name_a, name_b): the different spellings of one entity, smaller first."""
    l, r = resolved.alias("l"), resolved.alias("r")
    return l.join(r, (F.col("l.entity") == F.col("r.entity")) & (F.col("l.name") < F.col("r.name"))).select(F.col("l.name").alias("name_a"), F.col("r.name").alias("name_b"))
