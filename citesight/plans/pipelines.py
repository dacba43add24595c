"""Composed pipelines: clean -> mart -> facility features -> selection.

Each stage is a DataFrame -> DataFrame function; nothing is collected.  In a
production run the mart is written once (``write_table``) and both the
scoring and the reports read it back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets
from ..functions import (clean_text, collapse_ws, effective_class, highest_priority, parse_date,
                         recode, strip_tabs, title_case, token_count, utrim, yes_no_flag)
from ..operators.filters import drop_values, exclude_outcomes, flag_where, keyword_flags, standardize_columns
from ..operators.aggregates import table_report
from ..operators.joins import enrich_mart, is_small, scalar
from ..operators.profile import add_rates, eb_smooth, facility_profile, profile_columns, rate_name
from ..session import materialize
from ..sources import schemas, standin
from ..sources.quoted import scan_quoted
from ..sources.schemas import check_schema
from ..sources.tables import read_table
from ..sources.typed import RESCUED, count_rejects, merge, no_rejects, rescued, typed_scan
from ..sources.warehouse import Warehouse, content_digest


def clean_enforcement(df: DataFrame, preset: Mapping = presets.HEALTH,
                      category_recode: Mapping[str, str] | None = None) -> DataFrame:
    """Clean and recode raw penalty records (all columns kept).

    ``category_recode`` optionally standardises PENALTY_CATEGORY (trimmed,
    then recoded, unmapped values kept); by default categories are left as
    they are and the keyword flags read them raw."""
    caf = recode(strip_tabs(utrim(strip_tabs(utrim(F.col("CLASS_ASSESSED_FINAL"))))),
                 preset["class_final_recode"])
    cai = strip_tabs(utrim(F.col("CLASS_ASSESSED_INITIAL")))
    step1 = df.withColumns({
        "PENALTY_NUMBER": utrim("PENALTY_NUMBER"),
        "FAC_TYPE_CODE": F.upper(utrim("FAC_TYPE_CODE")),
        "FACID": utrim("FACID"),
        "PENALTY_ISSUE_DATE": parse_date("PENALTY_ISSUE_DATE"),
        "VIOLATION_FROM_DATE": parse_date("VIOLATION_FROM_DATE"),
        "DEATH_RELATED": F.coalesce(F.col("DEATH_RELATED"), F.lit(presets.DEATH_FILL)),
        "PENALTY_DETAIL": recode(collapse_ws(utrim("PENALTY_DETAIL")), preset["detail_recode"]),
        "CLASS_ASSESSED_INITIAL": cai,
        "CLASS_ASSESSED_FINAL": caf,
    })
    if category_recode:
        step1 = step1.withColumn("PENALTY_CATEGORY", recode(utrim("PENALTY_CATEGORY"), category_recode))
    return step1.withColumns({
        "CLASS_ASSESSED_FINAL": effective_class("CLASS_ASSESSED_INITIAL", "CLASS_ASSESSED_FINAL", "APPEALED"),
        "HIGHEST_PRIORITY": recode(highest_priority("PRIORITY_ALL", presets.PRIORITY_TOKENS),
                                   presets.PRIORITY_NUMBER, keep=False).cast("int"),
        "COMPLAINT_COUNT": token_count("PRIORITY_ALL").cast("int"),
        "DEATH_RELATED": recode(F.col("DEATH_RELATED"), presets.DEATH_MAP, keep=False).cast("int"),
        "APPEALED": yes_no_flag("APPEALED"),
    })


def clean_lookup(df: DataFrame) -> DataFrame:
    """Drop repeated header rows, trim VALUE, add the facility-type flags."""
    kept = drop_values(df, "VARIABLE", presets.LOOKUP_HEADER_VALUES).withColumn("VALUE", utrim("VALUE"))
    var, val = presets.LOOKUP_FLAG_ROW
    return flag_where(kept, F.col(var) == val, presets.LOOKUP_FLAGS, "DEFINITION")


def clean_narratives(df: DataFrame) -> DataFrame:
    """Title-case names, trim ids, clean the narrative text."""
    return (df.withColumns({
        "FACILITY_NAME": title_case("FACILITY_NAME"),
        "PENALTY_NUMBER": utrim("PENALTY_NUMBER"),
        "FACID": utrim("FACID"),
        "NARRATIVE_CLEAN": clean_text("NARRATIVE"),
    }))


def dims(lookup_clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facility-type dim and class dim from the cleaned lookup."""
    var, fac = presets.LOOKUP_FLAG_ROW
    _, cls = presets.LOOKUP_CLASS_ROW
    dim_fac = lookup_clean.where(F.col(var) == fac).select(
        "VARIABLE", "VALUE", "DESCRIPTION", "DEFINITION", "IS_24HR", "IS_HOSPITAL", "IS_LOW_RESOURCE")
    dim_class = lookup_clean.where(F.col(var) == cls).select("VARIABLE", "VALUE", "DESCRIPTION")
    return dim_fac, dim_class


def build_mart(enf_clean: DataFrame, lookup_clean: DataFrame) -> DataFrame:
    """The 26-column enriched mart."""
    # one bounded scan of the lookup proves both dims small
    return enrich_mart(enf_clean, *dims(lookup_clean), dims_small=is_small(lookup_clean))


def standin_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched mart built from the stand-in raw tables."""
    enf = clean_enforcement(standin.raw_enforcement(spark, sf_dir), presets.STANDIN)
    lk = clean_lookup(standin.raw_lookup(spark, sf_dir))
    return build_mart(enf, lk)


#: A facility's first penalty: by date, number and event, nulls last.
FIRST_ORDER = ["PENALTY_ISSUE_DATE", "PENALTY_NUMBER", "EVENTID"]


#: What profiles, flags and first penalties read of the mart.
SELECTION_COLUMNS = ["FACID", "IS_HOSPITAL", "CLASS_FINAL", "PENALTY_CATEGORY", "DEATH_RELATED", "APPEALED",
                     "TOTAL_BALANCE_DUE", "COMPLAINT_COUNT", "FACILITY_NAME", "DISTRICT_OFFICE", *FIRST_ORDER]


def selection_columns(mart: DataFrame) -> DataFrame:
    """The mart without the columns that no profile and no first penalty reads: what is
    stored for both to read, so that the others are not cleaned and written for nothing."""
    return mart.select(*SELECTION_COLUMNS)


def valid_penalties(mart: DataFrame, preset: Mapping) -> DataFrame:
    """Penalties without those that were voided."""
    return exclude_outcomes(mart, "CLASS_FINAL", preset["invalid_outcomes"])


def penalty_features(mart: DataFrame, preset: Mapping) -> DataFrame:
    """Valid penalties with keyword flags."""
    return keyword_flags(valid_penalties(mart, preset), "PENALTY_CATEGORY", preset["flags"])


def facility_table(flagged: DataFrame, preset: Mapping, hospital: bool, k: float = presets.EB_K,
                   checkpoint: bool = False) -> DataFrame:
    """Profile -> rates -> smoothed rates for one stratum.

    With ``checkpoint`` the (one row per facility) result is written to the
    checkpoint folder and read back, so that later global statistics and the
    forest start from it instead of from the raw penalty rows.
    """
    prof_preset = preset["hosp_profile"] if hospital else preset["ltc_profile"]
    stratum = flagged.where(F.col("IS_HOSPITAL") == (1 if hospital else 0))
    prof = facility_profile(stratum, prof_preset)
    counts = profile_columns(prof_preset)
    rated = add_rates(prof, counts)
    if checkpoint:
        rated = materialize(rated)
    return eb_smooth(rated, [rate_name(c) for c in counts], k=k)


# --------------------------------------------------------------- scoring

Z = "_z_"


def prepare_features(fac: DataFrame, features) -> DataFrame:
    """Median-imputed, standardised copies of ``features`` (prefixed ``_z_``)
    next to the original columns."""
    from ..operators.profile import impute_and_scale
    z = fac.withColumns({Z + c: F.col(c).cast("double") for c in features})
    return impute_and_scale(z, [Z + c for c in features])


def score_stratum(fac: DataFrame, features, contamination: float, n_trees: int = presets.N_TREES,
                  seed: int = presets.RANDOM_STATE, key: str = "FACID", score: bool = True):
    """Fit the forest on one stratum and, unless told not to, score it.  Returns
    ``(scored, model, prepared)``.  The prepared features are checkpointed
    (fit and score both read them); the scores are checkpointed inside
    ``score`` before the threshold is found."""
    from ..operators.forest import IsolationForest
    prepared = materialize(prepare_features(fac, features))
    zc = [Z + c for c in features]
    model = IsolationForest(n_trees=n_trees, max_samples=256, seed=seed).fit(prepared, zc, key)
    scored = model.score(prepared, contamination) if score else None
    return scored, model, prepared


def strata_tables(flagged: DataFrame, preset: Mapping, k: float = presets.EB_K) -> tuple[DataFrame, DataFrame]:
    """Hospital and LTC facility tables (profile -> rates -> smoothed rates)
    from a single aggregation pass over the penalty rows, checkpointed once."""
    from ..operators.profile import split_strata, strata_profiles
    hp, lp = preset["hosp_profile"], preset["ltc_profile"]
    grouped = materialize(strata_profiles(flagged, hp, lp))
    h, lt = split_strata(grouped, hp, lp)
    out = []
    for prof, pp in [(h, hp), (lt, lp)]:
        counts = profile_columns(pp)
        out.append(eb_smooth(add_rates(prof, counts), [rate_name(c) for c in counts], k=k))
    return out[0], out[1]


def score_facilities(mart: DataFrame, preset: Mapping = presets.HEALTH, n_trees: int = presets.N_TREES,
                     seed: int = presets.RANDOM_STATE, score: bool = True):
    """Both strata scored: ``{stratum: (scored, model, prepared)}``; without
    ``score`` only the model and its features (all that attribution needs)."""
    flagged = penalty_features(mart, preset)
    h, lt = strata_tables(flagged, preset)
    out = {}
    for fac, name, feats, contam in [
            (h, presets.STRATUM_HOSPITAL, preset["hosp_features"], presets.HOSP_CONTAMINATION),
            (lt, presets.STRATUM_LTC, preset["ltc_features"], presets.LTC_CONTAMINATION)]:
        out[name] = score_stratum(fac, feats, contam, n_trees, seed, score=score)
    return out


def inspection_list(mart: DataFrame, scored: Mapping, slots: int = presets.INSPECTION_SLOTS,
                    preset: Mapping = presets.HEALTH) -> DataFrame:
    """The inspection list: slots split over strata by flagged counts, the
    lowest anomaly scores of each stratum, ranked, with facility name and
    district of the first valid penalty attached."""
    from ..operators.joins import first_per_key
    from ..operators.selection import allocate_quota, top_k_strata, union_strata
    from ..operators.windows import with_rank
    hs = scored[presets.STRATUM_HOSPITAL][0]
    ls = scored[presets.STRATUM_LTC][0]
    hit = F.col("is_anomaly") == -1
    quotas = allocate_quota(hs, ls, hit, [presets.STRATUM_HOSPITAL, presets.STRATUM_LTC], slots)
    cols = ["FACID", "anomaly_score", "total_penalties", "deaths_rate", "balance_per_penalty"]
    both = union_strata(hs.select(*cols).withColumn("stratum", F.lit(presets.STRATUM_HOSPITAL)),
                        ls.select(*cols).withColumn("stratum", F.lit(presets.STRATUM_LTC)))
    top = top_k_strata(both, "anomaly_score", quotas, "FACID")
    ranked = with_rank(top, [F.col("anomaly_score"), F.col("FACID")])
    # at most `slots` keys: broadcast them to cut the mart down before de-duplicating
    wanted = valid_penalties(mart, preset).join(F.broadcast(ranked.select("FACID")), "FACID", "left_semi")
    info = first_per_key(wanted, "FACID", FIRST_ORDER, ["FACILITY_NAME", "DISTRICT_OFFICE"])
    return (ranked.join(info, "FACID", "left")
            .select("rank", "stratum", "FACID", "FACILITY_NAME", "DISTRICT_OFFICE", "anomaly_score",
                    "total_penalties", "deaths_rate", "balance_per_penalty"))


def attribution(scored: Mapping) -> DataFrame:
    """Global feature importance per stratum (mean |Shapley value|)."""
    from ..operators.attribution import feature_importance
    parts = []
    for name, (_, model, prepared) in scored.items():
        imp = feature_importance(model, prepared)
        parts.append(imp.select(F.lit(name).alias("stratum"),
                                F.regexp_replace("feature", "^" + Z, "").alias("feature"), "mean_abs"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def narrative_table(narratives: DataFrame) -> DataFrame:
    """Cleaned narratives with their keywords, as stored."""
    from ..operators.keywords import tfidf, top_keywords
    # penalty numbers repeat and can be NULL: the rows get an id of their own, written once
    nc = materialize(clean_narratives(narratives).withColumn("_DOC", F.monotonically_increasing_id()))
    kw = top_keywords(nc, tfidf(nc, "_DOC", "NARRATIVE_CLEAN"), "_DOC")
    return nc.join(kw, "_DOC", "left").select(*schemas.STORED_NARRATIVES.fieldNames())


def clean_with_rejects(enforcement: DataFrame, preset: Mapping) -> DataFrame:
    """Cleaned penalties with the rescue column: the texts of amounts that the
    scan could not cast (if it kept them) and of dates that could not be read."""
    dates = schemas.ENFORCEMENT_DATES
    kept = F.col(RESCUED) if RESCUED in enforcement.columns else no_rejects()
    raw = enforcement.withColumns({RESCUED: kept, **{f"_raw_{c}": F.col(c) for c in dates}})
    unread = rescued([(c, F.col(f"_raw_{c}"), F.col(c)) for c in dates])
    return clean_enforcement(raw, preset).withColumn(RESCUED, merge(F.col(RESCUED), unread)).drop(*[f"_raw_{c}" for c in dates])


def mart_proofs(fact: DataFrame, dim_fac: DataFrame, dim_class: DataFrame) -> DataFrame:
    """One row: what the mart's joins will do, before they are done.

    Penalties, the rows that the joins will make of them, keys that a dimension
    holds more than once (each multiplies rows), and penalties whose type or
    class is missing or not in its dimension.  The penalties are grouped once,
    by their pair of codes."""
    types = dim_fac.where("VALUE IS NOT NULL").groupBy(F.col("VALUE").alias("FAC_TYPE_CODE")).agg(F.count("*").alias("types"))
    classes = dim_class.where("DESCRIPTION IS NOT NULL").groupBy(F.col("DESCRIPTION").alias("CLASS_ASSESSED_FINAL")).agg(
        F.count("*").alias("classes"))
    codes = fact.groupBy("FAC_TYPE_CODE", "CLASS_ASSESSED_FINAL").agg(F.count("*").alias("n"))
    met = codes.join(types, "FAC_TYPE_CODE", "left").join(classes, "CLASS_ASSESSED_FINAL", "left")
    n, code, klass = F.col("n"), F.col("FAC_TYPE_CODE"), F.col("CLASS_ASSESSED_FINAL")

    def total(x):
        return F.coalesce(F.sum(x), F.lit(0)).cast("long")

    sums = met.agg(
        total(n).alias("fact_rows"), total(n * F.coalesce("types", F.lit(1)) * F.coalesce("classes", F.lit(1))).alias("mart_rows"),
        total(F.when(code.isNull(), n)).alias("type_missing"),
        total(F.when(code.isNotNull() & F.col("types").isNull(), n)).alias("type_unknown"),
        total(F.when(klass.isNull(), n)).alias("class_missing"),
        total(F.when(klass.isNotNull() & F.col("classes").isNull(), n)).alias("class_unknown"))
    return sums.withColumns({"repeated_types": scalar(types, F.count_if(F.col("types") > 1)),
                             "repeated_classes": scalar(classes, F.count_if(F.col("classes") > 1))})


#: Part of each stage's digest; raise it when a rule changes what a stage stores.
RULES = 1


def run_pipeline(spark: SparkSession, enforcement: DataFrame, lookup: DataFrame, narratives: DataFrame | None,
                 out_dir: str, preset: Mapping = presets.HEALTH, database: str | None = None,
                 resume: bool = True, strict: bool = True) -> dict[str, DataFrame]:
    """Whole run in one application: clean, store the star schema (fact, two
    dims, narratives with keywords, enriched mart), prove and validate the mart,
    score, select, explain.

    Tables go to a ``Warehouse`` under ``out_dir`` (and by name into
    ``database``), each replaced as a whole, penalties and mart clustered by
    facility.  They are returned as read back, with ``rejects`` (values of each
    column that could not be read), ``validation`` (rows and facilities of the
    mart and the counts of ``mart_proofs``) and ``preview`` (three of its rows).

    Every table keeps a digest of the rows, settings and tables that it was made
    from.  With ``resume`` a table whose digest is the same is taken as it is, so
    a run after a failure starts at the first table that is missing, and changed
    input makes all tables after it anew.  A dimension key that occurs more than
    once raises before it multiplies rows, unless not ``strict``."""
    wh, out = Warehouse(spark, out_dir, database), {}
    settings = json.dumps([RULES, preset], sort_keys=True, default=str)
    made: dict[str, str] = {}

    def store(name: str, inputs: Sequence[str], make, key: str | None = None, schema=None, **facts) -> DataFrame:
        made[name] = hashlib.sha256("\n".join([name, settings, *inputs]).encode()).hexdigest()
        entry = wh.current(name) if resume else None
        if entry is not None and entry.get("digest") == made[name]:
            out[name] = wh.table(name, schema)
        else:
            out[name] = wh.replace(name, make(), key=key, schema=schema, digest=made[name], **facts)
        return out[name]

    counted = [f.name for f in schemas.ENFORCEMENT.fields if not isinstance(f.dataType, T.StringType)] + [*schemas.ENFORCEMENT_DATES]
    seen: dict = {}

    def clean_fact() -> DataFrame:
        df, seen["fact"] = count_rejects(clean_with_rejects(enforcement, preset), counted)
        # stored before it is clustered: the rows are counted once, and cleaned once
        return materialize(check_schema(df, schemas.CLEAN_ENFORCEMENT))

    fact = store("fact_enforcement_actions", [content_digest(enforcement)], clean_fact, "FACID", schemas.CLEAN_ENFORCEMENT,
                 rejects=lambda: seen["fact"].get)
    counts = wh.current("fact_enforcement_actions")["rejects"]
    out["rejects"] = spark.createDataFrame([(c, counts[c]) for c in counted], "column string, rejected long")
    lk = materialize(clean_lookup(lookup))
    given = [content_digest(lookup)]
    dim_fac, dim_class = dims(lk)
    dim_fac, dim_class = store("dim_fac_code", given, lambda: dim_fac), store("dim_class_final", given, lambda: dim_class)

    proofs = mart_proofs(fact, dim_fac, dim_class).first()
    if strict and proofs.repeated_types + proofs.repeated_classes:
        raise ValueError(f"{proofs.repeated_types} facility types and {proofs.repeated_classes} classes occur more than once in the "
                         f"lookup: {proofs.fact_rows} penalties would become {proofs.mart_rows} rows")
    mart = store("enriched_mart", [made[n] for n in ("fact_enforcement_actions", "dim_fac_code", "dim_class_final")],
                 lambda: enrich_mart(fact, dim_fac, dim_class, dims_small=is_small(lk)), "FACID", schemas.MART)
    out["validation"] = table_report(mart, "FACID").select("*", *[F.lit(v).alias(c) for c, v in proofs.asDict().items()])
    out["preview"] = mart.limit(3)
    if narratives is not None:
        store("fact_ltc_narratives", [content_digest(narratives)], lambda: narrative_table(narratives), schema=schemas.STORED_NARRATIVES)
    scored = cache(lambda: score_facilities(mart, preset))
    store("inspection_list", [made["enriched_mart"]], lambda: inspection_list(mart, scored(), preset=preset))
    store("attribution", [made["enriched_mart"]], lambda: attribution(scored()))
    return out


def read_inputs(spark: SparkSession, enforcement: str, lookup: str, narratives: str | None = None,
                fmt: str = "csv", narratives_encoding: str = "ISO-8859-1",
                required: Sequence[str] = ("FACID",)):
    """Read the three raw inputs with declared schemas.

    Headers are normalised (strip + upper) before the schema is applied, so
    exports with ``" facid "``-style headers load.  Narratives are delimited
    Latin-1 text with quoted multi-line fields.  A ``required`` column of an
    input's schema must be there; any other missing one is NULL.  Penalties keep
    the text of values that are not of their column's type (``_RESCUED``)."""
    def typed(df, schema, rescue=False):
        return typed_scan(standardize_columns(df), schema, required, rescue)

    def load(path, schema, rescue=False):
        if fmt == "csv":
            raw = spark.read.option("header", True).csv(path)  # all text; typed below
            return typed(raw, schema, rescue)
        return typed(read_table(spark, path, fmt=fmt), schema, rescue)

    enf = load(enforcement, schemas.ENFORCEMENT, True)
    lk = load(lookup, schemas.LOOKUP)
    narr = None
    if narratives is not None:
        if fmt == "csv":
            narr = typed(scan_quoted(spark, narratives, narratives_encoding), schemas.NARRATIVES)
        else:
            narr = typed(read_table(spark, narratives, fmt=fmt), schemas.NARRATIVES)
    return enf, lk, narr
