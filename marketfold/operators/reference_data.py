"""Market reference data: metadata resolution, token bindings, lookups,
refresh (upsert) and subscription deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketfold.functions import constants as C
from marketfold.functions.exprs import strip_ws
from marketfold.session import cut_lineage

REFRESH_BLOCK_S = 86_400


def bindings_from_canonical(canonical: DataFrame) -> DataFrame:
    """Distinct token bindings observed on canonical prediction events
    (hash aggregate: partial-combined before the shuffle)."""
    p = canonical.filter(F.col("venue") == C.PREDICTION_VENUE)
    sym = F.regexp_extract(F.col("market_key"), "^pm-(.*)$", 1)
    return (p.select("asset_id", sym.alias("symbol"), "market_key", "side", "slug", "bucket_start_ts", "condition_id")
             .dropDuplicates(["asset_id"]))


# ---------------------------------------------------------------------------
# Landed metadata records (stand-in for the market-metadata HTTP lookup).

def metadata_landing(canonical: DataFrame) -> DataFrame:
    """``(slug, payload)`` JSON responses for every (symbol, 5-minute bucket)
    seen on prediction events; shapes cycle by bucket: JSON-in-string
    lists, reversed outcomes, unknown outcomes (positional fallback), real
    lists with snake_case keys, a single token (error), a blank token."""
    p = canonical.filter(F.col("venue") == C.PREDICTION_VENUE)
    b = (p.select("market_key", "slug", "bucket_start_ts", "condition_id")
          .dropDuplicates(["market_key", "bucket_start_ts"]))
    yes = F.concat_ws("-", F.col("market_key"), F.lit("yes"), F.col("bucket_start_ts").cast("string"))
    no = F.concat_ws("-", F.col("market_key"), F.lit("no"), F.col("bucket_start_ts").cast("string"))
    r = F.pmod(F.floor(F.col("bucket_start_ts") / F.lit(300)), F.lit(6))

    def q(x):
        return F.concat(F.lit('\\"'), x, F.lit('\\"'))

    def lst_str(*xs):
        return F.concat(F.lit('"['), F.concat_ws(", ", *[q(x) for x in xs]), F.lit(']"'))

    def lst(*xs):
        return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit('"'), x, F.lit('"')) for x in xs]), F.lit("]"))

    cond = F.col("condition_id")
    head = F.concat(F.lit('[{"slug":"'), F.col("slug"), F.lit('",'))
    body = (
        F.when(r == 0, F.concat(F.lit('"conditionId":"'), cond, F.lit('","clobTokenIds":'), lst_str(yes, no),
                                F.lit(',"outcomes":'), lst_str(F.lit("Up"), F.lit("Down"))))
         .when(r == 1, F.concat(F.lit('"conditionId":"'), cond, F.lit('","clobTokenIds":'), lst_str(no, yes),
                                F.lit(',"outcomes":'), lst_str(F.lit("Down"), F.lit("Up"))))
         .when(r == 2, F.concat(F.lit('"conditionId":"'), cond, F.lit('","clobTokenIds":'), lst_str(yes, no),
                                F.lit(',"outcomes":'), lst_str(F.lit("A"), F.lit("B"))))
         .when(r == 3, F.concat(F.lit('"condition_id":"'), cond, F.lit('","clob_token_ids":'), lst(yes, no),
                                F.lit(',"outcomes":'), lst(F.lit(" Yes "), F.lit("No"))))
         .when(r == 4, F.concat(F.lit('"conditionId":"'), cond, F.lit('","clobTokenIds":'), lst_str(yes),
                                F.lit(',"outcomes":'), lst_str(F.lit("Up"))))
         .otherwise(F.concat(F.lit('"conditionId":"'), cond, F.lit('","clobTokenIds":'), lst_str(F.lit(" "), yes, no),
                             F.lit(',"outcomes":'), lst_str(F.lit("x"), F.lit("Up"), F.lit("Down")))))
    return b.select("slug", F.concat(head, body, F.lit("}]")).alias("payload"))


def refresh_points(canonical: DataFrame, symbols: dict[str, str] | None = None) -> DataFrame:
    """Every (symbol, 5-minute bucket) in the run window of the prediction
    events: the lookups the resolver performs.  Each symbol explodes its days,
    spread over the tasks, and each (symbol, day) its buckets (no join)."""
    p = canonical.filter(F.col("venue") == C.PREDICTION_VENUE)
    w = C.SLUG_BUCKET_SECONDS
    rng = p.agg(F.min("recv_s").alias("lo"), F.max("recv_s").alias("hi"))
    syms = symbols or C.PREDICTION_SYMBOLS
    prefixes = F.create_map(*[x for s in syms for x in (F.lit(s), F.lit(C.SLUG_PREFIX[s]))])
    keys = F.create_map(*[x for s, mk in syms.items() for x in (F.lit(s), F.lit(mk))])
    out = rng.select(F.explode(F.array(*[F.lit(s) for s in syms])).alias("symbol"),
                     (F.col("lo") - F.pmod(F.col("lo"), F.lit(w))).alias("lo"),
                     (F.col("hi") - F.pmod(F.col("hi"), F.lit(w))).alias("hi"))
    day = w * max(1, 86400 // w)
    out = out.select("symbol", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / day), F.floor(F.col("hi") / day))).alias("d"))
    parts = int(canonical.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(parts, "symbol", "d")
    out = out.select("symbol", F.explode(F.sequence(F.greatest(F.col("lo"), F.col("d") * day), F.least(F.col("hi"), F.col("d") * day + day - w),
                                                    F.lit(w).cast("bigint"))).alias("bucket_start_ts"))
    return out.select("symbol", element(keys, "symbol").alias("market_key"), "bucket_start_ts",
                      F.concat_ws("-", element(prefixes, "symbol"), F.col("bucket_start_ts").cast("string")).alias("slug"))


def element(m: F.Column, key: str) -> F.Column:
    return F.element_at(m, F.col(key))


def listish(v) -> F.Column:
    """``normalize_listish`` over a VARIANT: list -> its elements as text;
    JSON text -> parsed list or [value]; other text -> [text]; blank -> []."""
    from marketfold.functions import jsonv as J
    as_list = F.transform(J.as_array(v), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None")))
    text = strip_ws(F.try_variant_get(v, "$", "string"))
    inner = F.try_parse_json(text)
    parsed = F.when(J.is_array(inner), F.transform(J.as_array(inner), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None")))) \
        .when(inner.isNotNull(), F.array(F.try_variant_get(inner, "$", "string")))
    from_text = F.when(text == "", F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(text)))
    return (F.when(J.is_array(v), as_list).when(J.is_string(v), from_text)
             .otherwise(F.array().cast("array<string>")))


def pick_yes_no(tokens: F.Column, outcomes: F.Column) -> tuple[F.Column, F.Column]:
    """Zip tokens with outcomes by index; the first token whose outcome is
    yes/up (no/down) wins; fall back to token 1 (token 2)."""
    zipped = F.transform(outcomes, lambda o, i: F.struct(
        F.lower(strip_ws(o)).alias("o"), F.coalesce(F.try_element_at(tokens, i + 1), F.lit("")).alias("t")))
    yes_hit = F.filter(zipped, lambda z: z["o"].isin(*C.YES_OUTCOMES) & (z["t"] != ""))
    no_hit = F.filter(zipped, lambda z: z["o"].isin(*C.NO_OUTCOMES) & (z["t"] != ""))
    yes = F.coalesce(F.try_element_at(yes_hit, F.lit(1))["t"], F.try_element_at(tokens, F.lit(1)), F.lit(""))
    no = F.coalesce(F.try_element_at(no_hit, F.lit(1))["t"],
                    F.when(F.size(tokens) >= 2, F.try_element_at(tokens, F.lit(2))), F.lit(""))
    return yes, no


def parse_landing(landing: DataFrame) -> DataFrame:
    """Per slug: the first response's first record -> condition id, token
    list (blank tokens dropped), outcome list and the yes/no pick.  Done on
    the landing table before the lookup join, so the JSON work is once per
    slug and never re-evaluated inside later filters."""
    from marketfold.functions import jsonv as J
    # Several responses for a slug: the smallest text, so the choice is the same on every run.
    first = landing.groupBy("slug").agg(F.min("payload").alias("payload"))
    v = F.try_parse_json(F.col("payload"))
    rec0 = F.when(J.is_array(v), F.try_element_at(J.as_array(v), F.lit(1)))
    df = first.select("slug", F.coalesce(F.size(J.as_array(v)) > 0, F.lit(False)).alias("found"),
                      F.when(J.is_object(rec0), rec0).alias("rec"))
    r = F.col("rec")
    raw_tokens = listish(J.first_truthy(r, "$.clobTokenIds", "$.clob_token_ids"))
    df = df.select("slug", "found",
                   F.coalesce(J.to_text(J.first_truthy(r, "$.conditionId", "$.condition_id")), F.lit("")).alias("condition_id"),
                   F.filter(F.transform(raw_tokens, lambda t: strip_ws(t)), lambda t: t != "").alias("tokens"),
                   F.transform(listish(J.field(r, "$.outcomes")), lambda t: strip_ws(t)).alias("outcomes"))
    yes, no = pick_yes_no(F.col("tokens"), F.col("outcomes"))
    return df.select("slug", "found", "condition_id", F.size("tokens").alias("n_tokens"),
                     yes.alias("yes_asset_id"), no.alias("no_asset_id"))


def resolve_markets(points: DataFrame, landing: DataFrame) -> DataFrame:
    """Resolver: one lookup per (symbol, bucket) against the parsed landing
    records (left join on slug).  Output carries either the meta columns or
    an ``error`` text (not found / fewer than 2 tokens / no yes-no pick)."""
    df = points.join(parse_landing(landing), "slug", "left")
    found = F.coalesce(F.col("found"), F.lit(False))
    err = (F.when(~found, F.concat(F.lit("gamma_market_not_found:"), F.col("slug")))
            .when(F.col("n_tokens") < 2, F.concat(F.lit("gamma_missing_token_ids:"), F.col("symbol"), F.lit(":"), F.col("slug")))
            .when((F.col("yes_asset_id") == "") | (F.col("no_asset_id") == ""),
                  F.concat(F.lit("gamma_missing_yes_no_assets:"), F.col("symbol"), F.lit(":"), F.col("slug"))))
    df = df.withColumn("error", err)
    meta_cols = ["condition_id", "yes_asset_id", "no_asset_id"]
    return df.select("symbol", "market_key", "bucket_start_ts", "slug",
                     *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in meta_cols], "error")


def meta_to_bindings(metas: DataFrame) -> DataFrame:
    """Each meta -> two binding rows (yes, no): an unpivot."""
    good = metas.filter(F.col("error").isNull()) if "error" in metas.columns else metas
    un = good.select("symbol", "market_key", "slug", "bucket_start_ts", "condition_id",
                     F.expr("stack(2, 'yes', yes_asset_id, 'no', no_asset_id) AS (side, asset_id)"))
    return un.select("asset_id", "symbol", "market_key", "side", "slug", "bucket_start_ts", "condition_id")


def bindings_by_asset(metas: DataFrame) -> DataFrame:
    """One binding per asset: of several, the later market's (by key, then
    bucket), and inside a meta the no side, as it is bound last."""
    un = meta_to_bindings(metas)
    last = F.max_by(F.struct(*[c for c in un.columns if c != "asset_id"]), F.struct("market_key", "bucket_start_ts", (F.col("side") == "no").alias("no")))
    return un.groupBy("asset_id").agg(last.alias("b")).select("asset_id", "b.*")


def meta_in_effect(metas: DataFrame) -> DataFrame:
    """Refresh semantics: at each refresh a market keeps its previous meta
    when the lookup fails: an as-of join of the refreshes with the successful
    lookups, in blocks of time.  ``changed`` marks refreshes whose binding set
    differs from the previous refresh's."""
    from marketfold.operators.asof import asof_join
    metas = cut_lineage(metas, "metas")
    fields = {"meta_bucket": "bucket_start_ts", "meta_slug": "slug", "condition_id": "condition_id", "yes_asset_id": "yes_asset_id", "no_asset_id": "no_asset_id"}
    found = metas.filter(F.col("error").isNull()).select("market_key", F.col("bucket_start_ts").alias("at"), F.struct(*[F.col(c).alias(n) for n, c in fields.items()]).alias("now"))
    points = metas.select("market_key", F.col("bucket_start_ts").alias("refresh_ts"), F.col("bucket_start_ts").alias("at"))
    df = asof_join(points, found, "market_key", "at", "now", block=REFRESH_BLOCK_S)
    # Lookups happen at refreshes, so what was in effect a second before is what the refresh before left.
    before = asof_join(points.withColumn("at", F.col("at") - 1), found.withColumnRenamed("now", "was"), "market_key", "at", "was", block=REFRESH_BLOCK_S)
    df = df.drop("at").join(before.drop("at"), ["market_key", "refresh_ts"]).withColumn("meta_changed", F.col("now").isNotNull() & ~F.col("now").eqNullSafe(F.col("was")))
    # The refresh as a whole changed something if any market's bindings did (a row per market).
    df = df.withColumn("bindings_changed", F.max("meta_changed").over(Window.partitionBy("refresh_ts")))
    return df.select("market_key", "refresh_ts", *[F.col(f"now.{n}").alias(n) for n in fields], "meta_changed", "bindings_changed")


def bindings_in_effect(effective: DataFrame) -> DataFrame:
    """Asset bindings after each refresh; where two markets bind one asset the
    later market (by key) and, inside a market, the no side wins."""
    un = effective.filter(F.col("yes_asset_id").isNotNull()).select("refresh_ts", "market_key", F.expr("stack(2, 0, yes_asset_id, 1, no_asset_id) AS (no, asset_id)"))
    best = un.groupBy("refresh_ts", "asset_id").agg(F.max(F.struct("market_key", "no")).alias("b"))
    return best.select("refresh_ts", "asset_id", F.col("b.market_key").alias("market_key"), F.when(F.col("b.no") == 1, "no").otherwise("yes").alias("side"))


def binding_changes(effective: DataFrame) -> DataFrame:
    """(asset_id, at, binding): what an asset is bound to from each refresh on.
    ``binding`` has ``bound`` false where the next refresh there is no longer
    binds the asset; where two markets bind it, the later one (by key) and,
    inside a market, the no side wins."""
    from marketfold.operators.asof import next_time
    un = effective.filter(F.col("yes_asset_id").isNotNull()).select("refresh_ts", "market_key", "meta_slug", "meta_bucket", "condition_id",
                                                                    F.expr("stack(2, 0, yes_asset_id, 1, no_asset_id) AS (no, asset_id)"))
    fields = [F.lit(True).alias("bound"), "market_key", "no", F.col("meta_slug").alias("slug"), F.col("meta_bucket").alias("bucket_start_ts"), "condition_id",
              F.col("refresh_ts").alias("since")]
    best = un.groupBy("refresh_ts", "asset_id").agg(F.max(F.struct(*fields)).alias("binding"))
    following = next_time(effective.select("refresh_ts"), "refresh_ts").filter("next_at IS NOT NULL")
    free = F.struct(F.lit(False).alias("bound"), *[F.lit(None).cast(t).alias(n) for n, t in (
        ("market_key", "string"), ("no", "int"), ("slug", "string"), ("bucket_start_ts", "bigint"), ("condition_id", "string"), ("since", "bigint"))])
    ends = best.join(following, "refresh_ts").select("asset_id", F.col("next_at").alias("at"), free.alias("binding"))
    return best.select("asset_id", F.col("refresh_ts").alias("at"), "binding").unionByName(ends).groupBy("asset_id", "at").agg(F.max("binding").alias("binding"))


def subscription_delta(effective: DataFrame) -> DataFrame:
    """Per refresh: assets to subscribe (desired - subscribed) and to
    unsubscribe (subscribed - desired); subscribed = the desired set of the
    refresh before, whenever that was; one aggregate on (refresh, asset)."""
    from marketfold.operators.asof import next_time
    desired = (effective.filter(F.col("yes_asset_id").isNotNull())
               .select("refresh_ts", F.explode(F.array_distinct(F.array("yes_asset_id", "no_asset_id"))).alias("asset_id")).distinct())
    # +1 where an asset is wanted, -1 at the next refresh: what does not cancel is a change.
    marks = desired.join(next_time(effective.select("refresh_ts"), "refresh_ts"), "refresh_ts").select("asset_id", F.explode(F.array(
        F.struct("refresh_ts", F.lit(1).alias("n")), F.struct(F.col("next_at").alias("refresh_ts"), F.lit(-1).alias("n")))).alias("m")).select("asset_id", "m.*")
    net = marks.filter("refresh_ts IS NOT NULL").groupBy("refresh_ts", "asset_id").agg(F.sum("n").alias("n")).filter("n <> 0")
    return net.select(
        "refresh_ts", "asset_id", F.when(F.col("n") > 0, F.lit("subscribe")).otherwise(F.lit("unsubscribe")).alias("op"))


def meta_events(metas: DataFrame) -> DataFrame:
    """Resolved metas as canonical ``meta`` rows: they arrive at the refresh,
    ahead of that second's feed rows, and set the identity gauges whatever
    the feed said before."""
    from marketfold.operators.canonical import conform
    good = metas.filter(F.col("error").isNull())
    return conform(good.select(F.lit(-1).cast("bigint").alias("seq"), F.col("bucket_start_ts").alias("pos"), F.col("bucket_start_ts").alias("recv_s"),
                               F.lit(C.PREDICTION_VENUE).alias("venue"), "market_key", F.lit("meta").alias("kind"), "slug", "bucket_start_ts", "condition_id"))
