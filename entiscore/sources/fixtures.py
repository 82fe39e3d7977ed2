"""Stand-in domain datasets derived from the driver's TPC-H-style tables.

The stand-ins only give rows in the schema the operators expect; they do
none of the operators' work. Each flat view below is one SQL select that
runs unchanged in Spark and DuckDB (see FIXTURES.md): Spark nests the flat
rows into the domain shape (arrays of structs per entity) and the DuckDB
oracles read the same flat rows directly.

Entity = ``part`` with id ``concat('P', p_partkey)``. Every view, and so every
nested array, covers the whole of its table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.sources.io import scan_entities

# sf_dir -> (folder holding materialised stand-ins, their schemas); see :func:`materialize`
_MATERIALISED: dict[str, tuple[str, dict]] = {}


def _cached(builder: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Read the stand-in from its materialised parquet copy when one exists."""
    name = builder.__name__

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        saved = _MATERIALISED.get(sf_dir)
        if saved is None:
            return builder(spark, sf_dir)
        base, schemas = saved
        if name in ("target", "target_rows"):  # entity table: read only the nested fields the operators use
            return scan_entities(spark, os.path.join(base, name))
        return spark.read.schema(schemas[name]).parquet(os.path.join(base, name))

    build.__name__ = name
    build.__doc__ = builder.__doc__
    build.uncached = builder
    return build

# Stand-in definitions (FIXTURES.md §2): view -> (table, columns). Every view
# covers its whole table; rows that an operator should pass over get values it
# does not look for.
FLAT_VIEWS: dict[str, tuple[str, list[str]]] = {
    "f_query": ("orders", [
        "case when o_orderkey % 10 = 0 then concat('P', o_custkey) else concat('P', o_orderkey) end as targetid",
    ]),
    "f_target": ("part", [
        "concat('P', p_partkey) as id",
        "p_name as approvedSymbol",
        "case p_type when 'STANDARD' then 'protein_coding' when 'SMALL' then '' when 'PROMO' then null else lower(p_type) end as biotype",
        "case when p_size % 5 <> 0 then null when p_size % 10 = 0 then 'null' else p_name end as tep_description",
    ]),
    "f_location": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_linenumber = 7 or l_partkey % 5 = 4 then 'GO' when l_partkey % 5 = 0 then 'uniprot' when l_partkey % 5 = 1 and l_linestatus = 'F' then 'HPA_additional' when l_partkey % 5 = 1 then 'HPA_main' when l_partkey % 5 = 2 and l_returnflag = 'R' then 'HPA_extracellular_location' when l_partkey % 5 = 2 then 'uniprot' when l_returnflag = 'R' then 'HPA_main' when l_returnflag = 'A' then 'uniprot' when l_linestatus = 'F' then 'HPA_additional' else 'HPA_extracellular_location' end as source",
        "case when l_linenumber = 4 then null else concat('SL-', l_suppkey) end as termSL",
        "case when l_tax = 0 and l_quantity > 40 then null else concat('L', l_linenumber) end as location",
    ]),
    "f_tractability": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_linenumber = 7 then 'Approved Drug' when l_suppkey % 3 = 0 then 'High-Quality Ligand' when l_suppkey % 3 = 1 then 'High-Quality Pocket' else 'Small Molecule Binder' end as category",
        "l_returnflag = 'R' and l_quantity <= 20 as value",
    ]),
    "f_safety": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_partkey % 7 > 0 and l_linenumber < 6 then concat('E', l_suppkey % 50) end as event",
    ]),
    "f_constraint": ("part", [
        "concat('P', p_partkey) as id",
        "case when p_size > 40 then 'mis' when p_size % 8 = 0 then 'syn' else 'lof' end as constraintType",
        "cast(p_size * 700 + p_partkey % 7 as int) as upperRank",
    ]),
    "f_homologue": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_linenumber = 7 then 'gene_split' when l_linenumber % 4 = 0 then 'ortholog_one2one' when l_linenumber % 4 = 1 then 'within_species_paralog' when l_linenumber % 4 = 2 then 'other_paralog' else 'ortholog_one2many' end as homologyType",
        "case when l_linestatus = 'F' then 'Mouse' else 'Rat' end as speciesName",
        "cast(5 * (l_partkey % 11) + 5 * cast(round(l_discount * 100) as int) as double) as queryPercentageIdentity",
    ]),
    "f_hallmark": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_partkey % 3 = 0 then 'invasion' when l_linenumber = 1 then 'TSG' when l_linenumber = 2 then 'oncogene' when l_linenumber = 3 then 'fusion' when l_linenumber = 4 then null else 'Oncogene' end as description",
    ]),
    "f_essential": ("orders", [
        "concat('P', o_custkey) as id",
        "case o_orderstatus when 'F' then true when 'O' then false else null end as isEssential",
    ]),
    "f_probe": ("lineitem", [
        "concat('P', l_partkey) as id",
        "case when l_linenumber < 7 and l_partkey % 9 > 0 then l_returnflag = 'R' and l_partkey % 2 = 0 end as isHighQuality",
        "case when l_linenumber = 7 then null else concat('MOA', l_suppkey % 12) end as mechanismOfAction",
        "cast(l_suppkey % 3 as int) as n_urls",
    ]),
    "f_phenotype": ("lineitem", [
        "case when l_quantity = 50 then 'P1' else concat('P', l_partkey) end as id",
        "concat('MP:', l_suppkey * 20 + l_orderkey % 25) as class_id",
        "case when l_partkey % 8 > 0 and l_linenumber < 7 then concat('class ', l_suppkey * 20 + l_orderkey % 25) end as label",
        "l_orderkey as record",
    ]),
    "f_score": ("part", [
        "concat('MP:', p_partkey) as class_id",
        "cast((4 - p_partkey % 5) as double) / 4 as score",
    ]),
    "f_molecule": ("orders", [
        "concat('D', o_orderkey) as drug_id",
        "o_orderstatus = 'F' as isApproved",
        "cast(substr(o_orderpriority, 1, 1) as int) - 2 as phase",
        "concat('DIS', o_custkey) as disease",
    ]),
    "f_linked_target": ("lineitem", [
        "concat('D', l_orderkey) as drug_id",
        "case when l_quantity <= 30 then concat('P', l_partkey) end as target_id",
    ]),
    "f_mechanism": ("lineitem", [
        "concat('ACT', l_suppkey % 3) as actionType",
        "case when l_quantity <= 26 then concat('D', l_orderkey) end as chembl",
    ]),
    "f_interaction": ("lineitem", [
        "case l_returnflag when 'R' then 'intact' when 'A' then 'string' else 'reactome' end as sourceDatabase",
        "concat('P', l_partkey) as targetA",
        "concat('P', l_suppkey * 20 + l_orderkey % 25) as targetB",
        "cast(round(l_discount * 100) as int) / cast(10 as double) as scoring",
    ]),
    "f_disease": ("customer", [
        "concat('DIS', c_custkey) as id",
        "concat('TA', c_custkey % 4) as area1",
        "concat('TA', 4 + c_custkey % 3) as area2",
    ]),
    "f_pair": ("part", [
        "concat('GENE', p_partkey * 3 + 1) as symbol",
        "concat('DIS', p_size % 25, ', DIS', (p_size + 1) % 25) as EFO_disease",
        "concat('TA', p_size % 4, ', TA', 4 + p_size % 3) as Therapy_area",
    ]),
    "f_symbol": ("part", [
        "case when p_size = 50 then null else concat('GENE', p_partkey * 3 + 1) end as symbol",
        "concat('P', p_partkey) as id",
    ]),
    "f_atlas": ("part", [
        "case when p_size > 48 then concat('P', cast(floor(p_partkey / 2) as bigint)) else concat('P', p_partkey) end as Ensembl",
        "case p_size % 6 when 0 then 'Tissue enriched' when 1 then 'Group enriched' when 2 then 'Tissue enhanced' when 3 then 'Low tissue specificity' when 4 then 'Not detected' else 'other' end as specificity",
        "case p_size % 5 when 0 then 'Detected in single' when 1 then 'Detected in some' when 2 then 'Detected in many' when 3 then 'Detected in all' else 'Not detected' end as distribution",
        "concat('HPA', p_partkey) as antibody",
    ]),
    "f_term": ("supplier", [
        "s_name as Name",
        "concat('SL-', s_suppkey) as term_id",
        "case when s_suppkey < 10 then null when s_suppkey % 4 = 0 then concat('SL-', cast(floor(s_suppkey / 10) as bigint), '; parent, SL-', cast(floor(s_suppkey / 20) as bigint), '; parent') else concat('SL-', cast(floor(s_suppkey / 10) as bigint), '; parent') end as is_a",
        "case when s_suppkey % 3 = 0 then null else concat('SL-', cast(floor(s_suppkey / 7) as bigint), '; whole, SL-', cast(floor(s_suppkey / 7) as bigint) + 1, '; whole') end as part_of",
    ]),
}

# Nested arrays of the entity table built from lineitem rows:
# target column -> flat view whose non-id columns become the struct fields.
LINEITEM_ARRAYS = {
    "subcellularLocations": "f_location",
    "tractability": "f_tractability",
    "safetyLiabilities": "f_safety",
    "homologues": "f_homologue",
    "hallmark_attributes": "f_hallmark",
    "chemicalProbes": "f_probe",
}


def view_sql(name: str) -> str:
    """The flat view as a SQL select (used by the DuckDB oracles)."""
    table, cols = FLAT_VIEWS[name]
    return f"SELECT {', '.join(cols)} FROM {table}"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def flat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A flat stand-in view as a Spark DataFrame."""
    table, cols = FLAT_VIEWS[name]
    return read_table(spark, sf_dir, table).selectExpr(*cols)


def _fields(name: str) -> dict[str, F.Column]:
    """The non-id columns of a flat view as ``{alias: expression}``."""
    out = {}
    for col in FLAT_VIEWS[name][1]:
        expr, alias = col.rsplit(" as ", 1)
        if alias != "id":
            out[alias] = F.expr(expr)
    return out


def _element(name: str):
    """The struct (array element) for one flat row.

    Two views need a shape change: a tractability row's ``category`` is the
    element's ``id`` field, and a probe row's ``n_urls`` stands for that many
    url entries."""
    f = _fields(name)
    if name == "f_tractability":
        f = {"id": f.pop("category"), **f}
    if name == "f_probe":
        n_urls = f.pop("n_urls")
        f["urls"] = F.transform(F.when(n_urls > 0, F.sequence(F.lit(1), n_urls)),
                                lambda i: F.struct(F.concat(F.lit("url"), i.cast("string")).alias("url")))
    return F.struct(*[e.alias(a) for a, e in f.items()])


@_cached
def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity table: one row per part with nested annotation arrays.

    One scan of ``lineitem`` feeds every array: its plain rows are shuffled by
    key, for they are much smaller than the arrays' elements, and grouped with
    one ``collect_list`` per array where they arrive; then one join onto the
    part-derived columns. Entities without lineitem rows get null arrays.
    """
    return _target(spark, sf_dir, [])


@_cached
def target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity table with repeated ids: the nested annotations of an entity
    are spread over one row per line status and return flag."""
    return _target(spark, sf_dir, ["l_linestatus", "l_returnflag"])


def _target(spark: SparkSession, sf_dir: str, split_by: list[str]) -> DataFrame:
    nested = (
        read_table(spark, sf_dir, "lineitem")
        .repartition("l_partkey")
        .groupBy("l_partkey", *split_by)
        .agg(*[F.collect_list(_element(v)).alias(col) for col, v in LINEITEM_ARRAYS.items()])
    )
    base = read_table(spark, sf_dir, "part").select("p_partkey",
        *[F.expr(c) for c in FLAT_VIEWS["f_target"][1]], F.array(_element("f_constraint")).alias("constraint"))
    return (
        base.join(nested, F.col("p_partkey") == F.col("l_partkey"), "left")
        .select(
            "id",
            "approvedSymbol",
            "biotype",
            "subcellularLocations",
            "tractability",
            "safetyLiabilities",
            "constraint",
            "homologues",
            F.when(F.col("hallmark_attributes").isNotNull(),
                   F.struct(F.col("hallmark_attributes").alias("attributes"))).alias("hallmarks"),
            F.struct(F.col("tep_description").alias("description")).alias("tep"),
            "chemicalProbes",
        )
    )


def _nest_by(df: DataFrame, key: str, out_key: str, array_col: str, fields: list[str]) -> DataFrame:
    return df.groupBy(F.col(key).alias(out_key)).agg(
        F.collect_list(F.struct(*fields)).alias(array_col)
    )


@_cached
def gene_essentiality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, geneEssentiality array<struct<isEssential>>)``, one row per id."""
    return _nest_by(flat(spark, sf_dir, "f_essential"), "id", "id", "geneEssentiality", ["isEssential"])


@_cached
def mouse_phenotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(targetFromSourceId, modelPhenotypeClasses array<struct<id,label>>)``,
    one row per (entity, record): ids repeat, and each flat row is one array
    element."""
    rows = read_table(spark, sf_dir, "lineitem").repartition("l_orderkey")  # plain rows are smaller than elements
    f = rows.selectExpr(*FLAT_VIEWS["f_phenotype"][1]).select("id", F.col("class_id").alias("cid"), "label", "record")
    return f.groupBy(F.col("id").alias("targetFromSourceId"), "record").agg(
        F.collect_list(F.struct(F.col("cid").alias("id"), F.col("label"))).alias("modelPhenotypeClasses")
    ).drop("record")


@_cached
def phenotype_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phenotype class score lookup ``(id, label, score, flag)`` (CSV shape)."""
    return flat(spark, sf_dir, "f_score").select(
        F.col("class_id").alias("id"),
        F.concat(F.lit("class "), F.substring_index("class_id", ":", -1)).alias("label"),
        F.col("score"),
        F.lit(None).cast("string").alias("flag"),
    )


@_cached
def molecule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, isApproved, maximumClinicalTrialPhase, linkedTargets.rows,
    linkedDiseases.rows)``; repeated (drug, target) pairs and null targets are kept."""
    rows = read_table(spark, sf_dir, "lineitem").repartition("l_orderkey")  # plain rows are smaller than elements
    target_id = _fields("f_linked_target")["target_id"].alias("target_id")
    links = rows.groupBy("l_orderkey").agg(F.collect_list(F.struct(target_id)).alias("rows"))
    m = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey", *FLAT_VIEWS["f_molecule"][1])
    return m.join(links, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("drug_id").alias("id"),
        "isApproved",
        F.col("phase").alias("maximumClinicalTrialPhase"),
        F.when(F.col("rows").isNotNull(), F.struct(F.col("rows.target_id").alias("rows"))).alias("linkedTargets"),
        F.struct(F.array(F.col("disease")).alias("rows")).alias("linkedDiseases"),
    )


@_cached
def mechanism_of_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(actionType, chemblIds array<string>)``, one record per flat row."""
    return flat(spark, sf_dir, "f_mechanism").select("actionType", F.array("chembl").alias("chemblIds"))


@_cached
def interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(spark, sf_dir, "f_interaction")


@_cached
def diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(spark, sf_dir, "f_disease").select("id", F.array("area1", "area2").alias("therapeuticAreas"))


@_cached
def symbol_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-shaped ``(hgnc_protein, EFO_disease, Therapy_area)``."""
    return flat(spark, sf_dir, "f_pair").withColumnRenamed("symbol", "hgnc_protein")


@_cached
def symbol_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol -> entity id map; some entities have no symbol."""
    return flat(spark, sf_dir, "f_symbol")


@_cached
def query_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids to report on: most are absent from the entity table, some repeat."""
    return flat(spark, sf_dir, "f_query")


@_cached
def tissue_atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atlas records with the JSON field names (blanks included)."""
    return flat(spark, sf_dir, "f_atlas").select(
        "Ensembl",
        F.col("specificity").alias("RNA tissue specificity"),
        F.col("distribution").alias("RNA tissue distribution"),
        F.array("antibody").alias("Antibody"),
    )


@_cached
def term_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term list in the TSV shape (``Name``, ``Subcellular location ID``,
    ``Is a``, ``Is part of``)."""
    return flat(spark, sf_dir, "f_term").select(
        "Name",
        F.col("term_id").alias("Subcellular location ID"),
        F.col("is_a").alias("Is a"),
        F.col("part_of").alias("Is part of"),
    )


DATASETS = ("target", "target_rows", "query_ids", "gene_essentiality", "mouse_phenotypes", "phenotype_scores", "molecule",
            "mechanism_of_action", "interaction", "diseases", "symbol_pairs", "symbol_map",
            "tissue_atlas", "term_table")


def materialize(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Write every stand-in dataset once as parquet below ``out_dir`` (a
    folder in the shared checkpoint location) and read them from there from
    now on. This cuts the stand-ins' lineage: operators then start from
    nested parquet files, as they do on real inputs."""
    schemas = {}
    for name in DATASETS:
        df = globals()[name].uncached(spark, sf_dir)
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
        schemas[name] = df.schema  # read back with it: no footer-based schema inference
    _MATERIALISED[sf_dir] = (out_dir, schemas)
    return out_dir


def forget_materialized(sf_dir: str) -> None:
    _MATERIALISED.pop(sf_dir, None)
