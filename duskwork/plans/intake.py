"""Taking in new agents, investors, plan accounts and portfolios."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import key_of, moment
from duskwork.functions.text import code, decode, has_text, joined, trimmed, yes_no
from duskwork.operators.audit import audit_rows
from duskwork.operators.durable import reuse, reuse_keys
from duskwork.operators.entities import resolve_entities
from duskwork.operators.filters import drop_matching, join_side, keep_matching, with_match
from duskwork.operators.incremental import high_water_mark, incremental_new
from duskwork.operators.joins import owners_of
from duskwork.operators.keys import assign_keys, assign_ordinals
from duskwork.operators.ranking import first_per_key, lookup_per_key
from duskwork.operators.roles import union_distinct
from duskwork.operators.sequences import last_key, reserved
from duskwork.plans.job import JobResult, Tables, chain, combine, union_audit
from duskwork.plans.portfolios import copy_beneficiaries, insert_portfolios, staged_references, traded_on
from duskwork.sources.codes import (
    ACTIVE, ACTIVE_CONTRACT, AUTHORITY, CORPORATE, CORPORATE_CLIENT, EXTERNAL_USER, FIRST_OWNER,
    FRONT_END_COMPANIES, INACTIVE, INDIVIDUAL, INTAKE_USER, INVESTOR_ROLE_NAME, JOINT, NO, NO_ENTITY, RESET,
    SECOND_OWNER, VALID_CONTRACT, YES,
)
from duskwork.sources.clustered import changed_since

# --- fixed values ---
AGENT_LOG_NAME = "NEW_AGENT"
INVESTOR_LOG_NAME = "NEW_USER"
ACCOUNT_LOG_NAME = "NEW_ACCT"
ENTITY_TABLES = ",R_CUSTOMER,R_CUSTUSER_MATRIX"

CONTRACT = ["chdrcoy", "chdrnum"]
USER_KEYS = (("r_user", "user_id"), ("r_user_info", "user_info_id"), ("r_user_role", "user_role_id"))


def clients_of(tables: Tables) -> DataFrame:
    return tables["ifsdmclntpf"].withColumn("client", code("clntnum"))


def known_users(tables: Tables) -> DataFrame:
    """Client number and latest user info id of every user."""
    infos = tables["r_user_info"].select(code("clntnum").alias("client"), "user_info_id")
    return lookup_per_key(infos, "client", "user_info_id").dropna(subset=["client"])


def is_active_contract() -> Column:
    return F.col("statcode").isin(*ACTIVE_CONTRACT) & F.col("chdrcoy").isin(*FRONT_END_COMPANIES)


def contract_owners(contracts: DataFrame, owner: str) -> DataFrame:
    """One row per contract and owner, main or joint."""
    both = contracts.withColumn("__main", code("cownnum")).withColumn("__joint", code("jownnum"))
    return owners_of(both, ["__main", "__joint"], owner).drop("__main", "__joint")


def investor_role(tables: Tables) -> Column:
    """Id of the investor role: NULL if there is none, an error if several."""
    return tables["r_role"].where(F.col("role_nm") == INVESTOR_ROLE_NAME).select("role_id").scalar()


def new_clients(tables: Tables, log_name: str, extra: Column | None = None) -> DataFrame:
    """Clients changed since the last success of ``log_name`` who are no users."""
    mark = high_water_mark(tables["eod_log"], log_name)
    changed = changed_since(tables["ifsdmclntpf"], "datime", mark)
    changed = changed if extra is None else changed & extra
    known = tables["r_user_info"].select(code("clntnum").alias("client"))
    return incremental_new(clients_of(tables), changed, known, "client", settle=reuse_keys)


def create_users(
    tables: Tables, clients: DataFrame, status: Column, reset: Column, as_of: datetime, log_name: str, with_role: bool
) -> JobResult:
    """One user and user info row per client number, and the investor role if asked."""
    chosen = first_per_key(clients, "client", [F.col("datime").desc(), "zemailadd", "cltmchg"])
    chosen = chosen.select(
        "client", "clntnum", status.alias("status"), reset.alias("pwd_regen_flag"),
        yes_no(has_text("zemailadd")).alias("email_notify_flag"),
    )
    numbered = assign_ordinals(reuse(chosen), ["client"], "__n")
    people = numbered.select(
        "clntnum", "status", "pwd_regen_flag", "email_notify_flag",
        *[(last_key(tables, table, key) + F.col("__n")).alias(key) for table, key in USER_KEYS],
    )
    people = reuse(people)
    taken = {names: people for names in USER_KEYS if with_role or names[0] != "r_user_role"}
    made = {"created_by": F.lit(INTAKE_USER), "dt_created": moment(as_of)}
    stamp = [v.alias(k) for k, v in made.items()]
    active = F.lit(ACTIVE).alias("status")
    added = {
        "r_user": people.select("user_id", "status", "pwd_regen_flag", "email_notify_flag", *stamp),
        "r_user_info": people.select(
            "user_info_id", "user_id", "clntnum", F.lit(EXTERNAL_USER).alias("user_type"), active, *stamp
        ),
    }
    touched, after = "R_USER,R_USER_INFO", [F.col("user_id"), F.col("user_info_id")]
    if with_role:
        added["r_user_role"] = people.select(
            "user_role_id", "user_id", investor_role(tables).alias("role_id"), active, *stamp
        )
        touched, after = f"{touched},R_USER_ROLE", [*after, F.col("user_role_id")]
    audit = audit_rows(people, log_name, touched, None, [*after, F.col("clntnum")], as_of)
    return JobResult.of(tables, (log_name,), reserved(tables, taken), added, audit, {log_name: people})


def new_agents(tables: Tables, as_of: datetime) -> JobResult:
    """Web-enabled clients who are live advisers and not users yet."""
    clients = new_clients(tables, AGENT_LOG_NAME, F.col("cltmchg") == YES)
    live = tables["ifsvwadv_mst"].where(F.col("termination_date") > str(key_of(as_of)))
    for listed in (live, tables["ifsvwclnt_mst_ifs"]):
        clients = keep_matching(clients, listed.select(code("clnt_num").alias("client")), "client")
    return create_users(tables, clients, F.lit(RESET), F.lit(YES), as_of, AGENT_LOG_NAME, with_role=False)


def new_investors(tables: Tables, as_of: datetime) -> JobResult:
    """Clients owning an active contract, alone or jointly, who are not users yet."""
    owners = contract_owners(tables["ifsdmchdrpf"].where(is_active_contract()), "client")
    clients = keep_matching(new_clients(tables, INVESTOR_LOG_NAME), owners, "client")
    web = F.col("cltmchg") == YES
    return create_users(
        tables, clients, F.when(web, RESET).otherwise(INACTIVE), F.when(web, YES).otherwise(NO), as_of,
        INVESTOR_LOG_NAME, with_role=True,
    )


def _pair(main: str = "main", joint: str = "joint") -> list[Column]:
    return [F.col(main), F.coalesce(F.col(joint), F.lit("")).alias("__joint")]


def new_entities(tables: Tables, contracts: DataFrame) -> DataFrame:
    """The entity of each (main, joint) owner pair of ``contracts``.

    Pairs without one get a new id, together with the type and authority of the
    pair's first contract; ``is_new`` tells them apart.
    """
    pairs = contracts.select("main", "joint").distinct()
    members = tables["r_user_info"].select("user_info_id", code("clntnum").alias("clntnum"))
    found = reuse(resolve_entities(pairs, tables["r_custuser_matrix"], members, reuse_keys))
    known = found.where(F.col("entity_id") != NO_ENTITY)
    missing = found.where(F.col("entity_id") == NO_ENTITY).select("main", *_pair()[1:])
    opener = F.min(F.struct("chdrcoy", "chdrnum", "dueflg")).alias("__opener")
    openers = contracts.select(*_pair(), "chdrcoy", "chdrnum", "dueflg").groupBy("main", "__joint").agg(opener)
    missing = missing.join(openers, ["main", "__joint"])
    kinds = first_per_key(clients_of(tables), "client", ["clttype"]).select(F.col("client").alias("main"), "clttype")
    missing = missing.join(join_side(kinds, "main"), "main", "left")
    single = F.col("__joint") == ""
    customer_type = F.when(~single, JOINT).when(F.col("clttype") == CORPORATE_CLIENT, CORPORATE).otherwise(INDIVIDUAL)
    authority = F.when(~single, decode(F.col("__opener")["dueflg"], AUTHORITY))
    created = assign_keys(
        missing.select(
            "main", "__joint", customer_type.alias("customer_type"), authority.alias("auth_type"),
            F.col("__opener")["chdrcoy"].alias("open_coy"), F.col("__opener")["chdrnum"].alias("open_num"),
        ),
        ["main", "__joint"], "entity_id", last_key(tables, "r_customer", "entityid"),
    ).withColumn("is_new", F.lit(True))
    old = known.select(*_pair(), "entity_id", F.lit(False).alias("is_new"))
    return created.unionByName(old, allowMissingColumns=True)


def open_accounts(tables: Tables, as_of: datetime) -> JobResult:
    """Plan accounts for new active contracts whose owners are all users.

    Contracts of the same owner pair share one entity, created once. A NULL or
    blank joint owner means there is none.
    """
    since = key_of(high_water_mark(tables["eod_log"], ACCOUNT_LOG_NAME))
    contracts = tables["ifsdmchdrpf"]
    fresh = incremental_new(
        contracts, is_active_contract() & changed_since(contracts, "modidate", since), tables["plan_acct"], CONTRACT,
        settle=reuse_keys,
    ).select(*CONTRACT, code("cownnum").alias("main"), code("jownnum").alias("joint"), "dueflg")
    fresh = first_per_key(fresh, CONTRACT, ["main", "joint", "dueflg"])
    users = known_users(tables)
    fresh = keep_matching(fresh, users.select(F.col("client").alias("main")), "main")
    fresh = with_match(fresh, users.select(F.col("client").alias("joint")), "joint", "__known")
    fresh = reuse(fresh.where(F.col("joint").isNull() | F.col("__known")).drop("__known"))

    entities = reuse(new_entities(tables, fresh))
    created = entities.where("is_new")
    opened = assign_keys(
        fresh.withColumn("__joint", F.coalesce("joint", F.lit(""))).join(
            join_side(entities.select("main", "__joint", "entity_id", "is_new", "open_coy", "open_num"), ["main", "__joint"]),
            ["main", "__joint"],
        ),
        CONTRACT, "acctid", last_key(tables, "plan_acct", "acctid"),
    )
    opened = reuse_keys(opened)

    stamp = [moment(as_of).alias("dt_created"), F.lit(INTAKE_USER).alias("created_by")]
    by_client = users.withColumnRenamed("client", "owner")
    member = F.explode(F.array(
        F.struct(F.lit(FIRST_OWNER).alias("relationship"), F.col("main").alias("owner")),
        F.struct(F.lit(SECOND_OWNER).alias("relationship"), F.col("__joint").alias("owner")),
    ))
    members = created.select("entity_id", member.alias("m")).select("entity_id", "m.*").where(F.col("owner") != "")
    members = members.join(by_client, "owner").select("entity_id", "relationship", "user_info_id")
    added = {
        "r_customer": created.select(F.col("entity_id").alias("entityid"), "customer_type", "auth_type", *stamp),
        "r_custuser_matrix": members,
        "plan_acct": opened.select("acctid", *CONTRACT, F.lit(ACTIVE).alias("status"), "entity_id", *stamp),
    }
    owners = [F.col("main"), F.when(F.col("__joint") != "", F.col("__joint"))]
    first_of_pair = F.col("is_new") & (F.col("chdrcoy") == F.col("open_coy")) & (F.col("chdrnum") == F.col("open_num"))
    touched = F.when(first_of_pair, f"PLAN_ACCT{ENTITY_TABLES}").otherwise("PLAN_ACCT")
    audit = union_audit(
        audit_rows(
            created, ACCOUNT_LOG_NAME, ENTITY_TABLES, None,
            joined("|", F.col("entity_id"), "|", owners[0], "|", owners[1]), as_of,
        ),
        audit_rows(
            opened, ACCOUNT_LOG_NAME, touched, None,
            [F.col("acctid"), F.col("chdrcoy"), F.col("chdrnum"), F.col("entity_id")], as_of,
        ),
    )
    taken = reserved(tables, {("r_customer", "entityid"): created, ("plan_acct", "acctid"): opened})
    return JobResult.of(tables, (ACCOUNT_LOG_NAME,), taken, added, audit, {ACCOUNT_LOG_NAME: opened})


def new_accounts(tables: Tables, as_of: datetime, match_company: bool = True) -> JobResult:
    """Accounts are opened; portfolios staged for the references traded on them go live, and
    their beneficiaries are copied."""
    accounts = open_accounts(tables, as_of)
    opened, state = accounts.out[ACCOUNT_LOG_NAME], accounts.over(tables)
    trades = tables["ifsdmutrnpf"].select(*CONTRACT, trimmed("ztranref").alias("reference"))
    on = CONTRACT if match_company else ["chdrnum"]
    references = reuse_keys(keep_matching(trades, opened, on).select("reference").distinct())
    traded = traded_on(state, references, match_company)
    portfolios = insert_portfolios(state, references, as_of, match_company, traded)
    beneficiaries = copy_beneficiaries(portfolios.over(state), references, as_of, match_company, traded)
    return combine(accounts, portfolios, beneficiaries)


def staged_portfolios(tables: Tables, as_of: datetime, match_company: bool = True) -> JobResult:
    """Staged portfolios of traded references whose account has none yet."""
    since = key_of(high_water_mark(tables["eod_log"], ACCOUNT_LOG_NAME))
    return insert_portfolios(tables, reuse_keys(staged_references(tables, since, match_company)), as_of, match_company)


def investor_roles(tables: Tables, as_of: datetime) -> JobResult:
    """Owners of valid active contracts who hold no role get the investor role."""
    active = tables["ifsdmchdrpf"].where(
        (F.col("validflag") == VALID_CONTRACT) & F.col("statcode").isin(*ACTIVE_CONTRACT)
    )
    owners = union_distinct(
        active.select(code("cownnum").alias("client")), active.select(code("jownnum").alias("client"))
    )
    infos = tables["r_user_info"].select(code("clntnum").alias("client"), "user_id")
    without = drop_matching(keep_matching(infos, owners, "client"), tables["r_user_role"], "user_id")
    users = reuse(without.select("user_id").distinct())
    given = assign_keys(users, ["user_id"], "user_role_id", last_key(tables, "r_user_role", "user_role_id"))
    rows = given.select(
        "user_role_id", "user_id", investor_role(tables).alias("role_id"), F.lit(ACTIVE).alias("status"),
        moment(as_of).alias("dt_created"), F.lit(INTAKE_USER).alias("created_by"),
        moment(as_of).alias("dt_updated"), F.lit(INTAKE_USER).alias("updated_by"),
    )
    return JobResult.of(tables, (), reserved(tables, {("r_user_role", "user_role_id"): users}), {"r_user_role": rows})


def take_in(tables: Tables, as_of: datetime) -> JobResult:
    """All intake steps, each on the tables the one before left."""
    return chain(tables, as_of, new_agents, new_investors, new_accounts, staged_portfolios, investor_roles)
