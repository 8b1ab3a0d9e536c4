"""Per-account adjusted production constraints.

The modelled script loops over accounts and recomputes everything per
account.  Here the account is a column: every account-dependent step is one
join / window over all accounts at once, and the account-independent part
(inventory projection and manufacturing uplift) is computed once.

Output form.  The model stores one column ``account_<code>`` per account.  We
keep the *sparse long form*: one row per constraint with ``corp_code`` NULL
holding the value every account shares, plus one row per (constraint,
account) where that account has its own value.  ``sinks.writers.write_wide``
turns it into the wide table.  A return constraint meets the accounts that send
returns to its location in that period, so rows x accounts is not formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.functions.scalar import (
    is_period_label, least_strict, not_equal_keep_null, not_starts, period_label, period_no_from_word,
    rint, round_half_even, safe_div, split_part, starts, sum0,
)
from servelens.operators.core import (
    carry_forward, expand_back, materialize, null_safe_join, top_with_ties,
)

KEYS = list(K.CONSTRAINT_KEYS)


# ---------------------------------------------------------------------------
# C1 transfer matrix
# ---------------------------------------------------------------------------

def transfer_matrix(transfers: DataFrame, keys=K.TRANSFER_KEYS, value: str = "return_volume") -> DataFrame:
    """Sum of ``return_volume`` by the six keys; rows with a NULL key drop out."""
    k = list(keys)
    return transfers.dropna(subset=k).groupBy(*k).agg(sum0(value).alias(value))


def transfer_pairs(transfers: DataFrame) -> DataFrame:
    """Volume by (renter corp, return location) (A2)."""
    return (transfers.dropna(subset=["renter_corp_code", "return_loc_code"])
            .groupBy(F.col("renter_corp_code").cast("string").alias("renter_corp_code"),
                     F.col("return_loc_code").cast("string").alias("return_loc_code"))
            .agg(sum0("return_volume").alias("return_volume")))


# ---------------------------------------------------------------------------
# C2 account selection, C3 status normalisation
# ---------------------------------------------------------------------------

def select_accounts(accounts: DataFrame, demand: DataFrame, customers: DataFrame, flag: str = "y",
                    exact: bool = False) -> DataFrame:
    """Flagged accounts that have demand through their customers.

    ``exact=False`` compares the flag case-insensitively.
    """
    f = F.col("evaluate") == flag if exact else F.lower(F.col("evaluate")) == flag.lower()
    acc = (accounts.where(f)
           .groupBy(F.col("corp_code").cast("string").alias("corp_code"), "corp_desc")
           .agg(F.min("evaluate").alias("evaluate")))
    # distinct customers with demand first: the demand rows are reduced
    # map-side before anything is shuffled
    buyers = demand.select("customername").distinct()
    with_corp = (customers.select("customername", F.col("corpcode").cast("string").alias("corp_code"))
                 .join(buyers, "customername", "left_semi")
                 .select("corp_code").where(F.col("corp_code").isNotNull()).distinct())
    return acc.join(with_corp, "corp_code", "left_semi")


def normalise_constraints(constraints: DataFrame, notes=K.REPAIR_NOTES) -> DataFrame:
    """Remember the status, then force ``Include`` for repair notes.

    An existing ``original_status_field`` is kept (a rerun must not lose
    it, Q2) and stale ``account_*`` columns are dropped first (Q1).
    """
    df = constraints.drop(*[c for c in constraints.columns if c.lower().startswith(K.ACCOUNT_COLUMN_PREFIX)])
    orig = K.ORIGINAL_STATUS_COLUMN
    if orig not in df.columns:
        df = df.withColumn(orig, F.col("status"))
    else:
        df = df.withColumn(orig, F.coalesce(F.col(orig), F.col("status")))
    return df.withColumn("status", F.when(F.col("notes").isin(*notes), F.lit(K.STATUS_INCLUDE))
                         .otherwise(F.col("status")))


# ---------------------------------------------------------------------------
# C4 inventory projection, C5 manufacturing uplift (account independent)
# ---------------------------------------------------------------------------

def _one_model(*dfs: DataFrame) -> list[DataFrame]:
    return [df.withColumn("__model", F.lit("")) for df in dfs]


def _parameter(df: DataFrame, model: str, parameters: DataFrame | None, **defaults) -> DataFrame:
    """Adds each parameter as a column: the model's value from the table, else the default."""
    given = [] if parameters is None else [c for c in defaults if c in parameters.columns]
    if given:
        own = parameters.select(model, *[F.col(c).alias(f"__own_{c}") for c in given])
        df = df.join(own, model, "left")
    for c, default in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(f"__own_{c}"), F.lit(default)) if c in given else F.lit(default))
    return df.drop(*[f"__own_{c}" for c in given])


def inventory_projection(constraints: DataFrame, demand: DataFrame, inventory_policies: DataFrame,
                         periods: DataFrame, horizon: int = K.HORIZON_PERIODS, cover_days: int = K.COVER_DAYS,
                         first_period: str = K.FIRST_PERIOD, model: str | None = None,
                         parameters: DataFrame | None = None) -> DataFrame:
    """Per period: issues, returns, manufacture, begin / end inventory and the
    gap to ``cover_days`` days of issues (C4).  Periods beyond ``horizon``
    are dropped; the annual row is removed (F10).

    ``model`` names the column that tells models apart in all four inputs; any
    number of models is projected in one pass.  ``parameters`` may then hold a row
    per model with columns ``horizon``, ``cover_days``, ``first_period`` (a column
    or value that is missing: the argument).  Without ``model`` the inputs are one model.
    """
    if model is None:
        inputs = _one_model(constraints, demand, inventory_policies, periods)
        return inventory_projection(*inputs, horizon, cover_days, first_period, "__model").drop("__model")
    p = F.col("periodname").isNotNull()
    d = F.lit(None).cast("double")
    key = [model, "periodname"]
    is_ret = starts("facilityname", K.RETURN_PREFIX)
    is_new = not_starts("facilityname", K.RETURN_PREFIX) & (F.col("productname") == K.PRODUCT_NEW)
    # every source adds partials per period to one union, aggregated once:
    # no join chain (qty LEFT returns LEFT opening FULL manufacture) is needed
    parts = [
        demand.where(p).select(*key, F.col("quantity").alias("q"), F.lit(1).alias("has_q")),
        constraints.where(p & (is_ret | is_new)).select(
            *key, F.when(is_ret, F.col("constraintvalue")).alias("r"),
            F.when(is_new, F.col("constraintvalue")).alias("m"), F.when(is_new, F.lit(1)).alias("has_m")),
        _parameter(inventory_policies, model, parameters, first_period=first_period).select(
            model, F.col("first_period").alias("periodname"), F.col("initialinventory").alias("i")),
    ]
    u = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    g = u.groupBy(*key).agg(
        F.max("has_q").alias("has_q"), F.max("has_m").alias("has_m"),
        sum0("q").alias("quantity"), sum0("r").alias("returns"), sum0("m").alias("mfg"), sum0("i").alias("init"))
    # returns and the opening balance only reach periods with demand (left joins from demand)
    g = g.where(F.col("has_q").isNotNull() | F.col("has_m").isNotNull()).select(
        *key, "quantity",
        F.when(F.col("has_q").isNotNull(), F.col("returns")).otherwise(d).alias("returns"),
        F.when(F.col("has_q").isNotNull(), F.col("init")).otherwise(d).alias("initialinventory"),
        "mfg")
    t = g.join(periods.select(*key, "workingdays"), key, "left")
    z = F.lit(0.0)
    t = t.select(*key,
                 F.coalesce("quantity", z).alias("quantity"), F.coalesce("returns", z).alias("returns"),
                 F.coalesce("initialinventory", z).alias("initialinventory"), F.coalesce("mfg", z).alias("mfg"),
                 F.coalesce("workingdays", F.lit(0)).cast("int").alias("workingdays"))
    t = t.where(is_period_label("periodname"))
    t = t.withColumn("net", F.col("returns") + F.col("mfg") - F.col("quantity"))
    t = carry_forward(t, "periodname", "initialinventory", "net", [model], name="begin_inventory")
    t = t.withColumn("end_inventory", F.col("begin_inventory") + F.col("returns") + F.col("mfg") - F.col("quantity"))
    t = _parameter(t, model, parameters, horizon=horizon, cover_days=cover_days)
    gap = rint(F.col("quantity") / F.col("workingdays") * F.col("cover_days") - F.col("begin_inventory"))
    t = t.withColumn("gap_6days", F.when(F.col("workingdays") != 0, gap))
    t = t.withColumn("period_no", period_no_from_word("periodname"))
    return t.where(F.col("period_no") <= F.col("horizon")).drop("net", "horizon", "cover_days")


def worst_gap(projection: DataFrame, model: str | None = None) -> DataFrame:
    """Periods whose gap equals the maximum gap (of their model), ties kept."""
    if model is None:  # the periods of one model
        return worst_gap(*_one_model(projection), "__model").drop("__model")
    return top_with_ties(projection, "gap_6days", [model])


def uplift_rows(projection: DataFrame, two_digit_labels: bool = False, floor_zero: bool = False,
                model: str | None = None) -> DataFrame:
    """Spread the worst gap over the periods before it.

    Every worst row is repeated by the count of the *first* worst row, and the
    counter runs on across ties (Q10), per model.  Labels use ``'Period 0%d'`` (Q8)
    unless ``two_digit_labels``.  A negative need (no shortage) lowers
    manufacture as in the model (Q9) unless ``floor_zero``.
    Output: (``model``,) ``periodname``, ``needed_mfg``.
    """
    if model is None:
        return uplift_rows(*_one_model(projection), two_digit_labels, floor_zero, "__model").drop("__model")
    w = worst_gap(projection, model).select(model, "period_no", "gap_6days")
    from pyspark.sql import Window
    order = Window.partitionBy(model).orderBy("period_no")
    w = (w.withColumn("tie", F.row_number().over(order) - 1)
         .withColumn("first_k", F.first("period_no").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    w = w.withColumn("n", F.col("first_k") - 1)
    w = w.withColumn("needed_mfg", F.when(F.col("period_no") - 1 != 0,
                                          F.col("gap_6days") / (F.col("period_no") - 1)))
    if floor_zero:
        w = w.withColumn("needed_mfg", F.greatest(F.col("needed_mfg"), F.lit(0.0)))
    e = expand_back(w, F.col("n"))
    counter = F.col("tie") * F.col("n") + F.col("j")
    return e.select(model, period_label(F.col("period_no") - counter, two_digit_labels).alias("periodname"), "needed_mfg")


def manufacturing_uplift(constraints: DataFrame, uplift: DataFrame, special_depot: str = K.SPECIAL_DEPOT,
                         model: str | None = None, parameters: DataFrame | None = None) -> DataFrame:
    """New-manufacture rows with ``adjusted_constraintvalue`` (C5): the special
    depot gets its value plus the uplift of the period; other manufacture rows
    get NULL (they keep their value at the fallback).  With ``model`` the depot
    may differ by model (column ``special_depot`` of ``parameters``)."""
    if model is None:
        return manufacturing_uplift(*_one_model(constraints, uplift), special_depot, "__model").drop("__model")
    columns = [*constraints.columns, "adjusted_constraintvalue"]
    new = constraints.where(not_starts("facilityname", K.RETURN_PREFIX) & (F.col("productname") == K.PRODUCT_NEW))
    new = _parameter(new, model, parameters, special_depot=special_depot)
    special = new.where(F.col("facilityname") == F.col("special_depot"))
    adj = special.join(uplift, [model, "periodname"], "left").withColumn(
        "adjusted_constraintvalue", F.col("constraintvalue") + F.coalesce(F.col("needed_mfg"), F.lit(0.0)))
    others = new.where(F.coalesce(F.col("facilityname") != F.col("special_depot"), F.lit(True))) \
        .withColumn("adjusted_constraintvalue", F.lit(None).cast("double"))
    return adj.select(*columns).unionByName(others.select(*columns))


def unchanged_repairs(constraints: DataFrame) -> DataFrame:
    """Repair rows at individual depots, which keep their value for every account."""
    return (constraints.where(not_starts("facilityname", K.RETURN_PREFIX)
                              & not_equal_keep_null("facilityname", K.DEPOT_GROUP)
                              & not_equal_keep_null("productname", K.PRODUCT_NEW))
            .withColumn("adjusted_constraintvalue", F.col("constraintvalue")))


# ---------------------------------------------------------------------------
# C6-C9 account dependent parts
# ---------------------------------------------------------------------------

def account_return_share(transfers: DataFrame, selected: DataFrame) -> DataFrame:
    """Share of each return location in an account's returns.

    Grouped per account code (Q24).  Rows per account are bounded by the
    number of return locations, so the per-account total is a window.
    """
    from pyspark.sql import Window
    pairs = transfer_pairs(transfers)
    acc = selected.select(F.col("corp_code").alias("renter_corp_code")).distinct()
    j = pairs.join(acc, "renter_corp_code", "inner").withColumnRenamed("renter_corp_code", "corp_code")
    tot = F.sum("return_volume").over(Window.partitionBy("corp_code"))
    return j.withColumn("share", safe_div(F.col("return_volume"), tot))


def account_demand(demand: DataFrame, customers: DataFrame, selected: DataFrame) -> DataFrame:
    """Issues per account and period (C7, A6); customers fan out (Q18).

    Demand is summed per (customer, period) before the join (the sum
    distributes over the customer fan-out), and only customers of the selected
    accounts take part, so the large demand table is never shuffled row by row.
    """
    per_cust = (demand.where(F.col("periodname").isNotNull())
                .groupBy("customername", "periodname").agg(F.sum("quantity").alias("quantity")))
    acc = selected.select("corp_code").distinct()
    cust = (customers.select("customername", F.col("corpcode").cast("string").alias("corp_code"))
            .join(acc, "corp_code", "left_semi"))
    return (per_cust.join(cust, "customername", "inner")
            .groupBy("corp_code", "periodname").agg(sum0("quantity").alias("quantity")))


def adjusted_returns(constraints: DataFrame, acct_demand: DataFrame, shares: DataFrame,
                     loss_rate: float = K.LOSS_RATE, scale: int = K.ROUND_SCALE,
                     always: str | None = None) -> DataFrame:
    """Return constraints after removing each account's returns, where that changes the value.

    ``adj = round(cv - min(cv / tot * (qty * share * loss), cv), 6)`` (half-even on the binary value) where
    ``tot`` is the facility-period total.  Only periods in which the account
    has demand count; all other pairs keep the original value and have no row.

    The accounts' demand and shares meet first, by account; the constraint rows then join
    them on (location, period), so a row meets only the accounts that send returns there.
    Without a share the formula still changes some rows, whatever the account (a value of more
    than ``scale`` decimals, a negative one, a zero total): only these join every account with
    demand in the period.  ``always`` names a boolean column of ``constraints``: rows
    that every account with demand gets even if unchanged.
    """
    cv = F.col("constraintvalue")
    keep = F.coalesce(F.col(always), F.lit(False)) if always else F.lit(False)

    def adjusted(taken):
        removed = safe_div(cv, F.col("facility_total")) * taken
        return round_half_even(cv - least_strict(removed, cv), scale)

    r = constraints.where(starts("facilityname", K.RETURN_PREFIX))
    # the total does not depend on the account: summed once, before the rows meet accounts
    tot = r.groupBy("facilityname", "periodname").agg(F.sum("constraintvalue").alias("facility_total"))
    r = r.join(tot, ["facilityname", "periodname"]).withColumn("loc_code", split_part("facilityname", "_", 2))
    sh = shares.select("corp_code", F.col("return_loc_code").alias("loc_code"), F.coalesce("share", F.lit(0.0)).alias("share"))
    senders = r.join(acct_demand.join(sh, "corp_code"), ["loc_code", "periodname"])
    odd = r.where(keep | ~adjusted(F.lit(0.0)).eqNullSafe(cv))
    others = (odd.join(acct_demand, "periodname").join(sh, ["corp_code", "loc_code"], "left_anti")
              .withColumn("share", F.lit(0.0)))
    j = senders.unionByName(others)
    j = j.withColumn("adjusted_constraintvalue", adjusted(F.col("quantity") * F.col("share") * F.lit(loss_rate)))
    return (j.where(keep | ~F.col("adjusted_constraintvalue").eqNullSafe(cv))
            .drop("loc_code", "share", "facility_total"))


def adjusted_depot_repairs(constraints: DataFrame, adjusted: DataFrame, acct_demand: DataFrame | None = None,
                           always: str | None = None) -> DataFrame:
    """Group repair minimum less the WIP no longer returned, where any is.

    ``wip = floor(sum(cv) - sum(adj))`` per account and period for WIP rows;
    the ``Depot`` rows get ``cv - wip`` and a NULL product name.  Rows that ``always``
    marks go to every account of ``acct_demand`` with demand in a period with WIP
    constraints, also where ``wip`` is 0.
    """
    is_wip = (F.col("productname") == K.PRODUCT_WIP) & F.col("periodname").isNotNull()
    depot = constraints.where(not_starts("facilityname", K.RETURN_PREFIX) & (F.col("facilityname") == K.DEPOT_GROUP))
    wip = (adjusted.where(is_wip).groupBy("corp_code", "periodname")
           .agg(F.floor(sum0("constraintvalue") - sum0("adjusted_constraintvalue")).cast("double").alias("wip")))
    if always:
        periods = constraints.where(starts("facilityname", K.RETURN_PREFIX) & is_wip).select("periodname").distinct()
        pairs = acct_demand.select("corp_code", "periodname").join(periods, "periodname", "left_semi")
        wip = pairs.join(wip, ["corp_code", "periodname"], "left").fillna(0.0, ["wip"])
        j = depot.join(wip, "periodname").where(F.coalesce(F.col(always), F.lit(False)) | (F.col("wip") != 0))
    else:
        j = depot.join(wip.where(F.col("wip") != 0), "periodname")
    return (j.withColumn("adjusted_constraintvalue", F.col("constraintvalue") - F.col("wip"))
            .withColumn("productname", F.lit(None).cast("string")).drop("wip"))


# ---------------------------------------------------------------------------
# C10 assembly
# ---------------------------------------------------------------------------

def _final_side(df: DataFrame) -> DataFrame:
    # the final rows carry the original status (the model resets it before the join)
    return df.withColumn("status", F.col(K.ORIGINAL_STATUS_COLUMN)).select(*KEYS, "adjusted_constraintvalue")


def _final_key(df: DataFrame, null_product: bool):
    """Key of an adjusted row: the 17 columns with the original status (and,
    for the depot group, no product name), packed in one struct."""
    cols = []
    for k in KEYS:
        if k == "status":
            cols.append(F.col(K.ORIGINAL_STATUS_COLUMN).alias(k))
        elif k == "productname" and null_product:
            cols.append(F.lit(None).cast("string").alias(k))
        else:
            cols.append(F.col(k).alias(k))
    return F.struct(*cols)


def _matched_sources(pc: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Return rows and depot-group rows, each with the constraint rows its adjusted value goes to.

    Rows match on the 17 keys (NULL = NULL) with the original status; both sides meet in one
    aggregate per key.  ``key`` holds the keys of the matched rows, ``targets`` their ids, values
    and ``extra`` columns (empty: no match), ``n_match`` the number of rows with these matches.
    ``fans_out`` marks rows that match others or share their match: they count for an account
    even if their own value stays.
    """
    is_return = starts("facilityname", K.RETURN_PREFIX)
    is_depot = F.coalesce(F.col("facilityname") == K.DEPOT_GROUP, F.lit(False)) & ~is_return
    rows = pc.where(is_return | is_depot)
    source = F.struct("row_id", "facilityname", "productname", "periodname", "constraintvalue")
    target = F.struct(F.col("row_id").alias("o_id"), "constraintvalue", *extra)
    # the keys hold the facility, so only these rows can be matched
    sides = (rows.where(is_return).select(_final_key(pc, False).alias("key"), source.alias("source"))
             .unionByName(rows.where(is_depot).select(_final_key(pc, True).alias("key"), source.alias("source")))
             .unionByName(rows.select(F.struct(*[F.col(k) for k in KEYS]).alias("key"), target.alias("target")),
                          allowMissingColumns=True))
    met = sides.groupBy("key").agg(F.collect_list("source").alias("sources"), F.collect_list("target").alias("targets"))
    each = met.select("key", "targets", F.size("sources").alias("n_match"), F.explode("sources").alias("s"))
    return each.select("s.*", "key", "n_match", "targets",
                       ((F.size("targets") > 0) & ((F.col("n_match") > 1) | F.exists("targets", lambda t: t["o_id"] != F.col("s.row_id"))))
                       .alias("fans_out"))


def build_account_constraints(constraints: DataFrame, demand: DataFrame, customers: DataFrame,
                              inventory_policies: DataFrame, periods: DataFrame, transfers: DataFrame,
                              selected: DataFrame, special_depot: str = K.SPECIAL_DEPOT,
                              loss_rate: float = K.LOSS_RATE, two_digit_labels: bool = False,
                              floor_zero: bool = False, persist: bool = True, row_ids: bool = False,
                              extra: Sequence[str] = ()) -> DataFrame:
    """Constraints + selected accounts -> per-account values (C3-C10 composed).

    The adjusted rows are matched to the constraints on the 17 key columns with
    NULL = NULL; a missing or NULL adjusted value falls back to ``constraintvalue``
    and duplicate keys fan out as in the model (J5, X17, Q6).  Rows with ``corp_code``
    NULL hold the value every account shares; an account has rows of its own where its
    value differs or where a constraint row has several matches.

    Planned for size: every constraint row gets a stable ``row_id`` (written once) and the
    17-key match between adjusted rows and constraint rows is resolved once, at the size of
    the constraint table (:func:`_matched_sources`).  A row takes its matches along when it
    meets the accounts, so the per-account rows are written once and never shuffled again.

    ``row_ids`` also returns ``row_id`` (the constraint row) and ``match_id`` (the
    row whose adjusted value it took, NULL for shared values), by which the wide
    table keeps every value of rows with equal keys.  ``extra`` names further
    columns of the constraint table that each row keeps.
    """
    pc = normalise_constraints(constraints)
    pc = materialize(pc.withColumn("row_id", F.monotonically_increasing_id()), "constraints")
    # the selected accounts (size of the account list) feed three branches;
    # written once so the demand table is not rescanned for each
    selected = materialize(selected.select("corp_code").distinct(), "accounts")
    proj = inventory_projection(pc, demand, inventory_policies, periods)
    mfg = manufacturing_uplift(pc, uplift_rows(proj, two_digit_labels, floor_zero), special_depot)
    shared = unchanged_repairs(pc).unionByName(mfg).drop("row_id", *extra)
    # return and depot rows with the constraint rows they match; read as returns and as depot rows
    sources = materialize(_matched_sources(pc, extra), "matches")
    # the demand per account is read three times, the shares and the adjusted returns twice
    # (per-account rows and depot WIP): each written once
    ad = materialize(account_demand(demand, customers, selected), "account_demand")
    shares = materialize(account_return_share(transfers, selected), "shares")
    adj = materialize(adjusted_returns(sources, ad, shares, loss_rate, always="fans_out"), "adjusted")
    depot = adjusted_depot_repairs(sources, adj, ad, always="fans_out")
    carried = ["row_id", "corp_code", "adjusted_constraintvalue", "key", "n_match", "targets"]
    own = adj.select(*carried).unionByName(depot.select(*carried)).select("*", F.explode("targets").alias("t"))
    own = own.select(F.col("t.o_id").alias("o_id"), F.col("row_id").alias("match_id"), "key.*",
                     *[F.col("t")[c].alias(c) for c in ("constraintvalue", *extra)], "corp_code", "n_match",
                     F.coalesce("adjusted_constraintvalue", F.col("t.constraintvalue")).alias("account_value"))
    own = own.where((F.col("n_match") > 1) | ~F.col("account_value").eqNullSafe(F.col("constraintvalue")))
    base = pc.select(F.col("row_id").alias("o_id"), *KEYS, "constraintvalue", *extra)
    ids = [F.col("o_id").alias("row_id"), "match_id"] if row_ids else []
    own = own.select(*ids, *KEYS, "constraintvalue", *extra, "corp_code", "account_value")
    sh = null_safe_join(base, _final_side(shared), KEYS, "left").withColumn("match_id", F.lit(None).cast("bigint"))
    sh = sh.select(*ids, *KEYS, "constraintvalue", *extra, F.lit(None).cast("string").alias("corp_code"),
                   F.coalesce("adjusted_constraintvalue", "constraintvalue").alias("account_value"))
    out = sh.unionByName(own)
    # the per-account values are the table the process persists for the
    # solver and the reports: materialise it
    return materialize(out, "account_values") if persist else out
