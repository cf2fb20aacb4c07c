"""Refinement: field text to structured values.

The values of a field are built as an array inside its row, so refinement never shuffles; the long
table is that array exploded.  The array expressions are higher-order functions on purpose: as
exploded rows the same patterns fuse into one generated method that is too long for the JIT
compiler and runs several times slower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.functions import markup as K
from fieldmill.functions import text as X
from fieldmill.functions.numbers import percentage
from fieldmill.functions.years import year_tag


def _year(value: Column, years: bool) -> Column:
    return year_tag(value) if years else F.lit(None).cast("string")


def _value(value: Column, order: Column, years: bool, key: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None).cast("string") if key is None else key).alias("key"),
        value.alias("value"),
        _year(value, years).alias("year"),
        order.cast("int").alias("order"),
        F.lit(None).cast("array<struct<value:string,year:string>>").alias("sub_values"),
    )


def _simple_values(data: Column, years: bool) -> Column:
    return F.transform(X.split_values(data), lambda v, i: _value(v, i, years))


def _single_key(pair: Column, years: bool, decode: bool) -> Column:
    """The one value of ``struct<k, c, i>``, the first strong tag."""
    nothing = F.lit(None).cast("string")

    def value(p: Column) -> Column:
        key, content = X.key_text(p["k"]), p["c"]
        if decode:
            key, content = K.decode_references(key), K.decode_value(content)
        return F.struct(
            key.alias("key"),
            nothing.alias("value"),
            nothing.alias("year"),
            F.lit(0).alias("order"),
            F.transform(
                X.split_values(content),
                lambda v: F.struct(v.alias("value"), _year(v, years).alias("year")),
            ).alias("sub_values"),
        )

    return F.transform(F.array(pair), value)


def _keyed(contents: Column, years: bool, decode: bool) -> Column:
    """Values of ``struct<k, c, i>``: key HTML, content, order.

    Each step names what the next one uses more than once.  A pair with an empty key or value is
    skipped; the orders of the others stay.
    """

    def read(x: Column) -> Column:
        key, value = X.key_text(x["k"]), X.flat_text(x["c"])
        if decode:
            key, value = K.decode_references(key), K.decode_value(value)
        return F.struct(key.alias("k"), value.alias("v"), x["i"].alias("i"))

    kept = F.filter(F.transform(contents, read), lambda x: (x["k"] != "") & (x["v"] != ""))
    return F.transform(kept, lambda x: _value(x["v"], x["i"], years, x["k"]))


def _pair_contents(data: Column) -> Column:
    return F.transform(
        X.strong_segments(data),
        lambda s, i: F.struct(
            X.key_html(s).alias("k"), X.pair_content(s).alias("c"), i.cast("int").alias("i")
        ),
    )


def _flat_contents(data: Column) -> Column:
    """Contents of text without nested elements, where all tags are beside each other."""
    # a pair ends at a note; a note's own content holds no further one
    before = F.transform(
        _pair_contents(data),
        lambda x: F.struct(x["k"].alias("k"), X.before_note(x["c"]).alias("c"), x["i"].alias("i")),
    )
    return F.concat(before, _note_contents(data))


def _note_contents(data: Column) -> Column:
    n_pairs = F.size(X.strong_segments(data))
    return F.transform(
        X.note_segments(data),
        lambda s, i: F.struct(
            F.lit("note").alias("k"), X.note_content(s).alias("c"), (i + n_pairs).cast("int").alias("i")
        ),
    )


def structured_values(
    data: Column, kind: Column, years: bool = True, decode_entities: bool = False
) -> Column:
    """``array<VALUE>`` for text of the given structure type; notes follow all pairs.

    Without ``years`` they stay null, which saves their patterns where values are only counted.  With
    ``decode_entities`` character references of keyed text are decoded, once it is cut; simple text
    keeps them.
    """
    noted = kind == X.KEY_VALUE_PAIRS_WITH_NOTES
    contents = F.when(
        K.is_flat(data),
        F.when(kind == X.KEY_WITH_SUB_VALUES, F.array(X.first_pair(data)))
        .when(noted, _flat_contents(data))
        .otherwise(_pair_contents(data)),
    ).otherwise(K.nested_contents(data, noted))
    return (
        F.when(kind == X.SIMPLE, _simple_values(data, years))
        .when(
            kind == X.KEY_WITH_SUB_VALUES,
            _single_key(F.get(contents, F.lit(0)), years, decode_entities),
        )
        .otherwise(_keyed(contents, years, decode_entities))
    )


def with_structure_type(fields: DataFrame) -> DataFrame:
    """Add ``structure_type``, counting the strong tags once."""
    return (
        fields.withColumn("_strongs", X.strong_count(F.col("data")))
        .withColumn("structure_type", X.structure_type(F.col("data"), F.col("_strongs")))
        .drop("_strongs")
    )


def refine_fields(
    fields: DataFrame,
    notes_multi_valued: bool = False,
    decode_entities: bool = False,
    years: bool = True,
) -> DataFrame:
    """Add ``structure_type``, ``values`` and ``is_multi_valued``; drop ``data`` and ``media``.

    Profiles, statistics and totals need only the number of values: ``years=False`` serves them.
    """
    kind = F.col("structure_type")
    return (
        with_structure_type(fields)
        .withColumn("values", structured_values(F.col("data"), kind, years, decode_entities))
        .withColumn(
            "is_multi_valued",
            X.is_multi_valued(kind, F.size("values"), notes_multi_valued),
        )
        .drop("data", "media")
    )


def value_rows(fields: DataFrame, decode_entities: bool = False, years: bool = True) -> DataFrame:
    """One row per leaf value of unrefined fields; see ``leaf_rows``.

    Without ``years`` the column stays null: inside an array the optimizer can't leave it out by itself.
    """
    return leaf_rows(refine_fields(fields, decode_entities=decode_entities, years=years))


def leaf_rows(refined: DataFrame) -> DataFrame:
    """One row per leaf value: the field's columns plus ``key, value, order, year``.

    ``order`` counts sub-values for text with a single key and values otherwise.
    """
    keep = [c for c in refined.columns if c not in ("values", "is_multi_valued", "subfields")]
    item = F.col("_item")
    single = F.array(F.struct(item["value"].alias("value"), item["year"].alias("year")))
    # An inner explode of a column makes the optimizer test the array's size first, further down the
    # plan, where the array would be computed a second time; an outer one does not.
    return (
        refined.select(*keep, F.explode_outer("values").alias("_item"))
        .filter(item.isNotNull())
        .select(
            *keep,
            item["key"].alias("key"),
            item["order"].alias("_order"),
            F.posexplode(
                F.when(
                    F.col("structure_type") == X.KEY_WITH_SUB_VALUES, item["sub_values"]
                ).otherwise(single)
            ).alias("_index", "_leaf"),
        )
        .select(
            *keep,
            "key",
            F.col("_leaf.value").alias("value"),
            F.when(F.col("structure_type") == X.KEY_WITH_SUB_VALUES, F.col("_index"))
            .otherwise(F.col("_order"))
            .alias("order"),
            F.col("_leaf.year").alias("year"),
        )
    )


def refine_documents(docs: DataFrame, notes_multi_valued: bool = False) -> DataFrame:
    """Refine the ``data.fields`` array of whole documents in place, without exploding.

    The output row is ``entity, refined_at, source_file, data, statistics``; assets are dropped.
    """
    typed = F.transform(
        F.coalesce(F.col("data.fields"), F.array().cast(_field_array_type(docs))),
        lambda f: F.struct(f.alias("f"), X.strong_count(f["data"]).alias("n")),
    )
    typed = F.transform(
        typed,
        lambda t: F.struct(
            t["f"].alias("f"), X.structure_type(t["f"]["data"], t["n"]).alias("kind")
        ),
    )
    valued = F.transform(
        typed,
        lambda t: F.struct(
            t["f"].alias("f"),
            t["kind"].alias("kind"),
            structured_values(t["f"]["data"], t["kind"]).alias("values"),
        ),
    )
    refined = F.transform(
        valued,
        lambda t: F.struct(
            t["f"]["name"].alias("name"),
            t["f"]["database_id"].alias("database_id"),
            t["f"]["category"].alias("category"),
            t["f"]["subfields"].alias("subfields"),
            t["f"]["has_ranking"].alias("has_ranking"),
            X.is_multi_valued(t["kind"], F.size(t["values"]), notes_multi_valued).alias(
                "is_multi_valued"
            ),
            t["kind"].alias("structure_type"),
            t["values"].alias("values"),
        ),
    )
    total = F.size("_fields")
    multi = F.size(F.filter("_fields", lambda f: f["is_multi_valued"]))
    return (
        docs.withColumn("_fields", refined)
        .withColumn("_multi", multi)
        .select(
            "entity",
            F.current_timestamp().alias("refined_at"),
            F.concat(F.lit("raw/"), F.col("entity"), F.lit(".json")).alias("source_file"),
            F.struct(F.col("data.metadata"), F.col("_fields").alias("fields")).alias("data"),
            F.struct(
                total.alias("total_fields"),
                F.col("_multi").alias("multi_valued_fields"),
                (total - F.col("_multi")).alias("single_valued_fields"),
            ).alias("statistics"),
        )
    )


def _field_array_type(docs: DataFrame):
    return docs.schema["data"].dataType["fields"].dataType


def explode_fields(docs: DataFrame) -> DataFrame:
    """One row per field of landed documents: ``entity, pos`` and the field's members."""
    return docs.select(
        "entity",
        F.col("data.metadata.name").alias("entity_name"),
        F.posexplode_outer("data.fields").alias("pos", "_field"),
    ).filter(F.col("pos").isNotNull()).select("entity", "entity_name", "pos", "_field.*")


def refinement_stats(refined: DataFrame) -> DataFrame:
    """Per entity: fields, multi-valued and single-valued ones."""
    return refined.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_fields"),
        F.count_if("is_multi_valued").alias("multi_valued_fields"),
        F.count_if(~F.col("is_multi_valued")).alias("single_valued_fields"),
    )


def refinement_summary(stats: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """One row over ``refinement_stats``."""
    summary = stats.agg(
        F.count(F.lit(1)).alias("successful_entities"),
        F.coalesce(F.sum("total_fields"), F.lit(0)).alias("total_fields_processed"),
        F.coalesce(F.sum("multi_valued_fields"), F.lit(0)).alias("total_multi_valued_fields"),
    )
    n_failed = F.lit(0).cast("bigint")
    if failed is not None:
        n_failed = failed.agg(F.count(F.lit(1))).scalar()
    total = F.col("successful_entities") + F.col("failed_entities")
    return summary.withColumn("failed_entities", n_failed).select(
        total.alias("total_entities"),
        "successful_entities",
        "failed_entities",
        "total_fields_processed",
        "total_multi_valued_fields",
        percentage(F.col("successful_entities"), total).alias("success_rate"),
        percentage(
            F.col("total_multi_valued_fields"), F.col("total_fields_processed")
        ).alias("multi_value_rate"),
    )
