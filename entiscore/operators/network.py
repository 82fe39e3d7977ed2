"""Interaction partners, drugs and disease areas.

Entities are matched to drugs through their interaction partners, and
drug–disease areas are matched to entity–disease areas. Every step works on
long (key, value) pairs and joins; drug lists per key are built last, and
only where a list is the published output (N2, N3, N7, N10). Such a list is as
long as its key has drugs; the long forms (:func:`drug_target_pairs`,
:func:`partner_drug_pairs`, :func:`matched_triples`) are there for keys of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.operators.joins import attach, attach_salted
from entiscore.operators.properties import _finish
from entiscore.session import stored

# Partner edges kept from this source above this score.
PARTNER_SOURCE = "intact"
PARTNER_MIN_SCORE = 0.42


def tractability_true(target: DataFrame, queryset: DataFrame | None = None, id_col: str = "id",
                      arr_col: str = "tractability") -> DataFrame:
    """The tractability entries whose value is true, as
    ``array<struct<id, value>>`` sorted by category; null when none."""
    kept = F.sort_array(F.filter(F.col(arr_col), lambda x: F.coalesce(x["value"], F.lit(False))))
    m = target.select(F.col(id_col).alias("id"), kept.alias("_k")).select(
        "id", F.when(F.size("_k") > 0, F.col("_k")).alias("drug"))
    return _finish(m, queryset)


def drug_target_pairs(molecule: DataFrame, targets_col: str = "linkedTargets.rows") -> DataFrame:
    """Long form of N2: one ``(target, drug)`` row per linked target entry
    (repeated links kept). A frame of stored links (:func:`stored_links`) is
    taken as it is."""
    if set(molecule.columns) == {"target", "drug"}:
        return molecule
    return (molecule.select(F.col("id").alias("drug"), F.explode(F.col(targets_col)).alias("target"))
            .where(F.col("target").isNotNull()).select("target", "drug"))


def stored_links(molecule: DataFrame, table: str, buckets: int, targets_col: str = "linkedTargets.rows",
                 path: str | None = None) -> DataFrame:
    """The links of :func:`drug_target_pairs`, exploded and shuffled once into a
    table (in the warehouse, or below ``path``) with ``buckets`` buckets of
    ``target``, sorted in each. N2, N3 and N7 take the frame in place of
    ``molecule`` and then plan no Exchange on its side. The table must not exist. A target that holds
    a large part of all links fills one bucket: ``buckets`` follows the data,
    and N8, which deals such a target out, keeps to ``molecule``."""
    links = drug_target_pairs(molecule, targets_col)
    writer = (links.repartition(buckets, "target").write.mode("errorifexists").option("compression", "zstd")
              .bucketBy(buckets, "target").sortBy("target"))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return molecule.sparkSession.table(table)


def drugs_per_target(molecule: DataFrame, targets_col: str = "linkedTargets.rows") -> DataFrame:
    """Per target the sorted list of linked drug ids, repeats kept."""
    return (drug_target_pairs(molecule, targets_col)
            .groupBy("target").agg(F.sort_array(F.collect_list("drug")).alias("CHEMBL")))


def kept_edges(interaction: DataFrame, source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """Edges from ``source`` with ``scoring > min_score``, one per (targetA,
    targetB), with the largest ``scoring`` and the ``sourceDatabase``."""
    return (interaction.where((F.col("sourceDatabase") == F.lit(source)) & (F.col("scoring") > F.lit(min_score)))
            .groupBy("targetA", "targetB").agg(F.first("sourceDatabase").alias("sourceDatabase"), F.max("scoring").alias("scoring")))


def partner_edges(interaction: DataFrame, queryset: DataFrame, source: str = PARTNER_SOURCE,
                  min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """Distinct partner edges of the query-set ids: ``targetid, targetA,
    targetB, sourceDatabase, scoring``; ids without partners keep one row of
    nulls. Ids are deduplicated before the join and edges are distinct, so the
    result needs no further dedupe."""
    ids = queryset.select("targetid").distinct()
    edges = kept_edges(interaction, source, min_score).withColumn("_a", F.col("targetA"))
    return attach(ids, edges, on="_a", fanout=True)


def reached_drugs(molecule: DataFrame, interaction: DataFrame, queryset: DataFrame, source: str = PARTNER_SOURCE,
                  min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """``(entity, drug)`` for every drug link of every partner of a query-set
    id (inner joins; repeats kept)."""
    ids = queryset.select("targetid").distinct()
    edges = kept_edges(interaction, source, min_score).select("targetA", "targetB")
    mine = edges.join(ids, F.col("targetA") == F.col("targetid"), "inner").select(F.col("targetid").alias("entity"), "targetB")
    return mine.join(drug_target_pairs(molecule), F.col("targetB") == F.col("target"), "inner").select("entity", "drug")


def partner_drug_pairs(molecule: DataFrame, interaction: DataFrame, queryset: DataFrame,
                       source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """Long form of N3: the edge columns and one ``drug`` a row (null without)."""
    edges = partner_edges(interaction, queryset, source, min_score)
    return attach(edges, drug_target_pairs(molecule), on="target", qkey="targetB", fanout=True)


EDGE_COLUMNS = ("targetid", "targetA", "targetB", "sourceDatabase", "scoring")


def partner_drugs(molecule: DataFrame, interaction: DataFrame, queryset: DataFrame,
                  source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """Each entity's partner edges and the partner's drug list ``CHEMBL``
    (sorted, repeats kept; null when the partner has no drug or there is no
    partner)."""
    edges = partner_edges(interaction, queryset, source, min_score)
    return _with_drugs(edges, molecule)


def _with_drugs(edges: DataFrame, molecule: DataFrame) -> DataFrame:
    return edges.join(drugs_per_target(molecule), F.col("targetB") == F.col("target"), "left").drop("target")


def disease_areas(diseases: DataFrame, id_col: str = "id", areas_col: str = "therapeuticAreas") -> DataFrame:
    """One row per disease × therapeutic area (outer: no area → null)."""
    return diseases.select(F.col(id_col).alias("id"), F.explode_outer(F.col(areas_col)).alias("IndTherArea"))


def drug_disease_area(molecule: DataFrame, interaction: DataFrame, diseases: DataFrame, queryset: DataFrame,
                      source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """One row per (drug, disease, area, entity) where the entity reaches
    the drug through a partner; repeats kept. Drugs of partners are matched
    by an inner join (edges without a drug drop out), diseases and areas
    by outer joins."""
    reached = reached_drugs(molecule, interaction, queryset, source, min_score).withColumnRenamed("entity", "_entity")
    drug_dis = molecule.select(F.col("id").alias("_d"), F.explode_outer("linkedDiseases.rows").alias("inddisease_name"))
    areas = disease_areas(diseases).withColumnRenamed("id", "_dis")
    return (
        reached.join(drug_dis, F.col("drug") == F.col("_d"), "left").drop("_d")
        .join(areas, F.col("inddisease_name") == F.col("_dis"), "left").drop("_dis")
        .select("drug", "inddisease_name", F.col("IndTherArea").alias("IndTherAreaDrug"), F.col("_entity").alias("target"))
    )


def _split_items(col):
    return F.explode(F.split(col, ","))


def pairs_from_csv(pairs: DataFrame, symbol_map: DataFrame, symbol_col: str = "hgnc_protein",
                   disease_col: str = "EFO_disease", area_col: str = "Therapy_area") -> DataFrame:
    """Map each symbol to its entity id (left join on ``symbol_map``
    ``(symbol, id)``), then one row per (area item × disease item); items are
    trimmed, rows with no areas or no diseases drop out."""
    mapped = pairs.join(symbol_map.withColumnRenamed("symbol", "_sym"),
                        F.col(symbol_col) == F.col("_sym"), "left")
    return (
        mapped.select("id", _split_items(F.col(area_col)).alias("_a"), F.col(disease_col).alias("_d"))
        .select("id", "_a", _split_items(F.col("_d")).alias("_dn"))
        .select("id", F.trim("_a").alias("ind_disease_therapy"), F.trim("_dn").alias("ind_disease_name"))
    )


def partner_names(molecule: DataFrame, interaction: DataFrame, queryset: DataFrame, target: DataFrame, id_col: str = "id",
                  symbol_col: str = "approvedSymbol", source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """N3 with the partner's symbol ``Symbol_targetB``. Symbols are joined
    to the bare edges; the drug lists come last."""
    names = target.select(F.col(id_col).alias("_pid"), F.col(symbol_col).alias("Symbol_targetB"))
    edges = partner_edges(interaction, queryset, source, min_score)
    return _with_drugs(edges.join(names, F.col("targetB") == F.col("_pid"), "left").drop("_pid"), molecule)


def target_drug_pairs(pairs: DataFrame, molecule: DataFrame, interaction: DataFrame, queryset: DataFrame,
                      source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """entity–disease–area rows (N6) with every drug reachable through a
    partner (``ChEMBL``), repeats kept; rows without such a drug keep a null.
    The reached drugs are stored once in the shared scratch folder; an entity that
    holds a large share of them is dealt out over salts
    (:func:`~entiscore.operators.joins.attach_salted`), and its pair rows with it."""
    reached = stored(reached_drugs(molecule, interaction, queryset, source, min_score), "reached-drugs")
    out = attach_salted(pairs, reached, on="entity", qkey="id")
    return out.select("id", F.col("drug").alias("ChEMBL"), "ind_disease_therapy", "ind_disease_name")


def matched_triples(pairs: DataFrame, molecule: DataFrame, interaction: DataFrame, diseases: DataFrame, queryset: DataFrame,
                    source: str = PARTNER_SOURCE, min_score: float = PARTNER_MIN_SCORE) -> DataFrame:
    """Distinct (entity, drug, area) present on both sides: N8 rows matched
    to N5 rows on area, entity and drug.

    Edges get the areas of their entity (N6) and drug links those of the drug's
    diseases, a list each, before they meet at the partner: only areas in both
    become rows, which are made distinct, and no join takes all (entity, drug) pairs."""
    # An entity's areas: at most the number of therapy areas there are.
    wanted = (pairs.where(F.col("ind_disease_therapy").isNotNull()).groupBy("id").agg(F.collect_set("ind_disease_therapy").alias("_areas")))
    edges = interaction.where((F.col("sourceDatabase") == F.lit(source)) & (F.col("scoring") > F.lit(min_score))).select("targetA", "targetB")
    edges = edges.join(queryset, F.col("targetA") == F.col("targetid"), "left_semi").join(wanted, F.col("targetA") == F.col("id"))
    disease = molecule.select(F.col("id").alias("_d"), F.explode("linkedDiseases.rows").alias("_dis"))
    areas = disease_areas(diseases).where(F.col("IndTherArea").isNotNull()).withColumnRenamed("id", "_area_of")
    drug_areas = disease.join(areas, F.col("_dis") == F.col("_area_of")).groupBy("_d").agg(F.collect_set("IndTherArea").alias("_has"))
    links = drug_target_pairs(molecule).join(drug_areas, F.col("drug") == F.col("_d"))
    met = edges.join(links, F.col("targetB") == F.col("target")).select("id", "drug", F.explode(F.array_intersect("_areas", "_has")).alias("ind_disease_therapy"))
    both = met.distinct()
    return both.select("id", F.col("drug").alias("ChEMBL"), "ind_disease_therapy", F.col("ind_disease_therapy").alias("IndTherAreaDrug"))


def matched_drugs(triples: DataFrame) -> DataFrame:
    """Per entity the sorted list of matched drugs (one entry per matched
    area)."""
    return triples.groupBy("id").agg(F.sort_array(F.collect_list("ChEMBL")).alias("CHEMBL"))
