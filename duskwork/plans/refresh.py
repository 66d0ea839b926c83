"""Refreshing the status of plan accounts and users."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import key_of, moment
from duskwork.functions.text import code
from duskwork.operators.filters import join_side, keep_matching
from duskwork.operators.incremental import high_water_mark
from duskwork.operators.mutate import is_true, update_where
from duskwork.operators.roles import activity_actions
from duskwork.plans.intake import contract_owners, is_active_contract
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.codes import (
    ACTIVE, ACTIVE_CONTRACT, EXTERNAL_USER, FRONT_END_COMPANIES, INACTIVE, NO, ROLE_ADVISER, ROLE_INVESTOR, YES,
)

# --- fixed values ---
ACCOUNTS_LOG_NAME = "REFRESH PLANACCT"
USERS_LOG_NAME = "REFRESH USR"
RULE_OFF_WEB, RULE_OTHER_LIVE, RULE_OTHER_ENDED = "2A", "2B", "2B-ii"
RULE_BOTH, RULE_ADVISER, RULE_INVESTOR = "2C", "2D", "2E"


def follow_contracts(
    accounts: DataFrame, contracts: DataFrame, closed: Column, active: Column, as_of: datetime, *,
    on: tuple[str, ...] = ("chdrcoy", "chdrnum"), stop_by: str = f"{ACCOUNTS_LOG_NAME} A",
    restart_by: str = f"{ACCOUNTS_LOG_NAME} B",
) -> DataFrame:
    """Two updates in order: accounts of closed contracts become inactive, then
    inactive accounts of active contracts become active.

    Both conditions are combined per contract first, so the accounts are joined
    once.
    """
    keys = list(on)
    facts = contracts.select(*keys, is_true(closed).alias("__closed"), is_true(active).alias("__active"))
    facts = facts.where("__closed OR __active").groupBy(*keys).agg(
        F.max("__closed").alias("__closed"), F.max("__active").alias("__active")
    )
    joined = accounts.join(join_side(facts.dropna(subset=keys), keys), keys, "left")
    stopped = update_where(joined, F.col("__closed"), {
        "status": F.lit(INACTIVE), "dt_updated": moment(as_of), "updated_by": F.lit(stop_by),
    })
    restarted = update_where(stopped, F.col("__active") & (F.col("status") == INACTIVE), {
        "status": F.lit(ACTIVE), "dt_updated": moment(as_of), "updated_by": F.lit(restart_by),
    })
    return restarted.select(*accounts.columns)


def refresh_accounts(tables: Tables, as_of: datetime, match_company: bool = True) -> JobResult:
    """Plan accounts follow the state of their contracts.

    ``match_company=False`` matches accounts to contracts by number alone when
    setting the status.
    """
    since = key_of(high_water_mark(tables["eod_log"], ACCOUNTS_LOG_NAME))
    accounts, contracts = tables["plan_acct"], tables["ifsdmchdrpf"]
    closed = ~F.col("statcode").isin(*ACTIVE_CONTRACT) & (F.col("modidate") > since)
    active = is_active_contract()
    if match_company:
        new = follow_contracts(accounts, contracts, closed, active, as_of)
    else:
        never = F.lit(False)
        stopped = follow_contracts(accounts, contracts, closed, never, as_of, on=("chdrnum",))
        idle = stopped.where(F.col("status") == INACTIVE)
        back = keep_matching(contracts.where(active), idle, ["chdrcoy", "chdrnum"]).select("chdrnum").distinct()
        back = join_side(back.withColumn("__back", F.lit(True)), "chdrnum")
        new = update_where(stopped.join(back, "chdrnum", "left"), F.col("__back"), {
            "status": F.lit(ACTIVE), "dt_updated": moment(as_of), "updated_by": F.lit(f"{ACCOUNTS_LOG_NAME} B"),
        }).select(*accounts.columns)
    return JobResult({"plan_acct": new}, (ACCOUNTS_LOG_NAME,), touched={"plan_acct": stamped(new, ACCOUNTS_LOG_NAME, as_of)})


def stamped(state: DataFrame, by: str, as_of: datetime) -> DataFrame:
    """Rows that a job has changed, by the moment and name it leaves on them."""
    return state.where((F.col("dt_updated") == moment(as_of)) & F.startswith("updated_by", F.lit(by)))


def any_flags(on: list[str], *frames: DataFrame) -> DataFrame:
    """One row per key: every flag that some frame has, true where any row says so.

    The frames are stacked, so one shuffle of map-side combined flags serves them all.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).dropna(subset=on)
    return stacked.groupBy(*on).agg(
        *[F.coalesce(F.max(n), F.lit(False)).alias(n) for n in stacked.columns if n not in on]
    )


def client_flags(tables: Tables, as_of: datetime) -> DataFrame:
    """What the status rules ask about each client: web access, contracts, agent roles."""
    today, yes = key_of(as_of), F.lit(True)
    web = tables["ifsdmclntpf"].select(
        code("clntnum").alias("client"), (F.col("cltmchg") == YES).alias("on_web"), (F.col("cltmchg") == NO).alias("off_web")
    )
    contracts = tables["ifsdmchdrpf"].where(F.col("statcode").isin(*ACTIVE_CONTRACT))
    owners = contract_owners(contracts.where(is_active_contract()), "client").select("client", yes.alias("owned"))

    agents = tables["ifsdmaglfpf"].select("agntnum", "agntcoy", "zlfagtcl", "dtetrm", code("clntnum").alias("client"))
    open_after, open_from = F.col("dtetrm") > today, F.col("dtetrm") >= today
    front_end = F.col("agntcoy").isin(*FRONT_END_COMPANIES)
    role = F.col("role_type")
    other = ~role.isin(ROLE_INVESTOR, ROLE_ADVISER)
    roles = tables["r_role"].select("role_id", "role_type")
    agent_roles = agents.join(tables["r_agt_cl_role_map"], "zlfagtcl").join(roles, "role_id").select(
        "client",
        (other & open_after).alias("other_open"), (other & (F.col("dtetrm") <= today)).alias("other_past"),
        (open_after & front_end).alias("front_end_open"),
        ((role == ROLE_ADVISER) & front_end & open_from).alias("adviser_open"),
        ((role != ROLE_ADVISER) & open_from).alias("not_adviser_open"),
    )

    by_company = contracts.select("chdrcoy", F.col("servagnt").alias("agntnum")).dropna().distinct()
    serving = agents.join(join_side(by_company, "agntnum"), "agntnum").select(
        "client", "chdrcoy", (open_after & F.col("chdrcoy").isin(*FRONT_END_COMPANIES)).alias("served"), yes.alias("serves")
    )
    live = agents.where(open_from & front_end).select("client", F.col("agntcoy").alias("chdrcoy"), yes.alias("live"))
    companies = any_flags(["client", "chdrcoy"], serving, live).select(
        "client", "served", (F.col("serves") & F.col("live")).alias("serves_live"), F.col("live").alias("live_company")
    )
    return any_flags(["client"], web, owners, agent_roles, companies)


def user_facts(tables: Tables, as_of: datetime) -> DataFrame:
    """One row per user with a flag for each set the status rules ask about."""
    f = F.col
    info = tables["r_user_info"].select("user_id", "user_type", code("clntnum").alias("client"))
    info = info.join(join_side(client_flags(tables, as_of), "client"), "client", "left")
    external = f("user_type") == EXTERNAL_USER
    on_web = external & f("on_web")
    people = info.select(
        "user_id", "off_web", "owned", "served", "serves_live", "live_company", on_web.alias("on_web"),
        *[(on_web & f(n)).alias(n) for n in ("other_open", "other_past", "front_end_open", "adviser_open")],
        (external & f("not_adviser_open")).alias("not_adviser_open"),
    )
    roles = tables["r_role"].select("role_id", "role_type")
    held = tables["v_userrole"].select("user_id", "role_id").join(roles, "role_id").groupBy("user_id").agg(
        F.countDistinct("role_id").alias("n"), F.max(f("role_type") == ROLE_ADVISER).alias("v"),
        F.max(f("role_type") == ROLE_INVESTOR).alias("i"), F.max(f("role_type") != ROLE_INVESTOR).alias("beyond_investor"),
    ).select("user_id", ((f("n") == 2) & f("v") & f("i")).alias("adviser_investor"), "beyond_investor")
    assigned = tables["r_user_role"].select("user_id", F.lit(True).alias("assigned"))
    return any_flags(["user_id"], people, held, assigned).select(
        "user_id", "off_web", "owned", "served", "serves_live", f("other_open").alias("other_live"),
        (f("other_past") & ~f("front_end_open")).alias("other_ended"),
        (f("on_web") & f("adviser_investor")).alias("both"),
        (f("adviser_open") & ~f("not_adviser_open") & ~f("assigned") & f("live_company")).alias("adviser_only"),
        (f("on_web") & f("assigned") & ~f("beyond_investor")).alias("investor_only"),
    )


def with_facts(users: DataFrame, facts: dict[str, DataFrame], user: str = "user_id") -> DataFrame:
    """``users`` plus one boolean column per set of user ids.

    The sets are stacked and combined to one row per user, so the users are
    joined once however many sets there are.
    """
    tagged = [df.select(user, F.lit(name).alias("__fact")).dropna() for name, df in facts.items()]
    stacked = reduce(DataFrame.unionByName, tagged)
    flags = stacked.groupBy(user).agg(*[F.max(F.col("__fact") == n).alias(n) for n in facts])
    out = users.join(join_side(flags, user), user, "left")
    return out.select(*users.columns, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in facts])


def _stop(users: DataFrame, condition: Column, by: str, as_of: datetime) -> DataFrame:
    return update_where(users, condition, {
        "status": F.lit(INACTIVE), "dt_updated": moment(as_of), "updated_by": F.lit(by),
    })


def _ask_reset(users: DataFrame, condition: Column, by: str, as_of: datetime) -> DataFrame:
    return update_where(users, condition, {
        "dt_updated": moment(as_of), "updated_by": F.lit(by), "pwd_regen_flag": F.lit(YES),
        "dt_reset_password_updated": moment(as_of),
    })


def refresh_users(tables: Tables, as_of: datetime) -> JobResult:
    """Status rules in order, each seeing the status the one before left."""
    users = tables["r_user"]
    facts = user_facts(tables, as_of)
    state = users.join(join_side(facts, "user_id"), "user_id", "left").select(
        *users.columns, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in facts.columns if n != "user_id"]
    )
    status, f = F.col("status"), F.col

    state = _stop(state, f("off_web") & (status != INACTIVE), f"{USERS_LOG_NAME} {RULE_OFF_WEB}", as_of)
    state = _ask_reset(state, f("other_live") & (status == INACTIVE), f"{USERS_LOG_NAME} {RULE_OTHER_LIVE}", as_of)
    state = _stop(
        state, f("other_ended") & (status == ACTIVE) & ~f("owned"), f"{USERS_LOG_NAME} {RULE_OTHER_ENDED}", as_of
    )
    for group, active, rule in (
        ("both", f("served") | f("owned"), RULE_BOTH),
        ("adviser_only", f("serves_live"), RULE_ADVISER),
        ("investor_only", f("owned"), RULE_INVESTOR),
    ):
        reset, stop = activity_actions(status, f(group), active)
        # one user meets only one of the two, so their order does not matter
        state = state.withColumn("__reset", reset).withColumn("__stop", stop)
        state = _ask_reset(state, f("__reset"), f"{USERS_LOG_NAME} {rule}", as_of)
        state = _stop(state, f("__stop"), f"{USERS_LOG_NAME} {rule}", as_of).drop("__reset", "__stop")
    state = state.select(*users.columns)
    return JobResult({"r_user": state}, (USERS_LOG_NAME,), touched={"r_user": stamped(state, USERS_LOG_NAME, as_of)})
