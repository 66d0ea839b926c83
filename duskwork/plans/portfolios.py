"""Staged portfolios and beneficiaries of new accounts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.functions.dates import moment
from duskwork.functions.text import joined, trimmed
from duskwork.operators.audit import run_log
from duskwork.operators.durable import reuse, reuse_keys
from duskwork.operators.filters import join_side, keep_matching
from duskwork.operators.mutate import update_from
from duskwork.operators.ranking import first_per_key
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.clustered import changed_since
from duskwork.sources.codes import FAILURE, INTAKE_USER

# --- fixed values ---
BENEFICIARY_STEP = "updatebeneficialplanacct"

BENEFICIARY_COLUMNS = (
    "beneficial_name", "beneficial_name_2", "beneficial_nric", "beneficial_nric_2",
    "beneficial_relationship", "beneficial_relationship_2", "branch_name",
)


def named_transactions(transactions: DataFrame) -> DataFrame:
    """(reference, account_temp_id) of all transactions, references trimmed."""
    return transactions.select(
        trimmed("e_reference_number").alias("reference"), F.col("account_id").alias("account_temp_id")
    )


def staged_transactions(transactions: DataFrame, staged: DataFrame, references: DataFrame) -> DataFrame:
    """(reference, account_temp_id) of transactions on a staged account whose
    trimmed reference is among ``references``.

    The staged accounts, few next to all transactions, are applied first.
    """
    return keep_matching(keep_matching(named_transactions(transactions), staged, "account_temp_id"), references, "reference")


@dataclass(frozen=True)
class Traded:
    """What a set of references leads to, written once for all steps that take some of them:
    their transactions (reference, account_temp_id) and their accounts (reference, acctid)."""

    transactions: DataFrame
    accounts: DataFrame

    def on(self, staged: DataFrame) -> DataFrame:
        """The transactions on a staged account."""
        return reuse_keys(keep_matching(self.transactions, staged, "account_temp_id"))

    def accounts_of(self, some: DataFrame) -> DataFrame:
        """(reference, acctid) of some of the references."""
        return keep_matching(self.accounts, some, "reference")


def traded_on(tables: Tables, references: DataFrame, match_company: bool = True) -> Traded:
    """Transactions and accounts of ``references``, each found in one pass."""
    named = keep_matching(named_transactions(tables["trx_ut"]), references, "reference")
    return Traded(reuse(named), reuse(accounts_of(tables, references, match_company)))


def account_keys(match_company: bool) -> list[str]:
    """Columns by which an account belongs to a contract."""
    return ["chdrcoy", "chdrnum"] if match_company else ["chdrnum"]


def accounts_of(tables: Tables, references: DataFrame, match_company: bool = True) -> DataFrame:
    """Distinct (reference, acctid): accounts of the contracts a reference traded on.

    The trades found are written, so that of contracts and accounts only theirs are moved.
    """
    trades = tables["ifsdmutrnpf"].select(trimmed("ztranref").alias("reference"), "chdrcoy", "chdrnum")
    trades = reuse_keys(keep_matching(trades, references, "reference").distinct())
    contracts = keep_matching(tables["ifsdmchdrpf"].select("chdrcoy", "chdrnum"), trades, ["chdrcoy", "chdrnum"])
    on = account_keys(match_company)
    accounts = keep_matching(tables["plan_acct"].select(*on, "acctid"), trades, on)
    trades = keep_matching(trades, contracts, ["chdrcoy", "chdrnum"])
    return trades.select("reference", *on).join(accounts, on).select("reference", "acctid").distinct()


def insert_portfolios(
    tables: Tables, references: DataFrame, as_of: datetime, match_company: bool = True, traded: Traded | None = None
) -> JobResult:
    """Staged portfolios and targets of a set of references become live.

    Their transactions are written once: portfolios, targets and the search for accounts read
    them. ``traded`` has them and the accounts if another step on these references needs them too.
    """
    staged = tables["tmp_portfolio"]
    trx = traded.on(staged) if traded else reuse_keys(staged_transactions(tables["trx_ut"], staged, references))
    accounts = traded.accounts_of(trx) if traded else accounts_of(tables, trx, match_company)
    rows = (
        staged.join(trx.distinct(), "account_temp_id")
        .join(accounts, "reference")
        .select(*[c for c in staged.columns if c != "account_temp_id"], "acctid").distinct()
    )
    portfolio = rows.select(
        "portfolio_id", "risk_category_nm", "exp_return", "status", F.col("acctid").alias("acct_id"),
        "portfolio_model_id", "portfolio_builder_type",
        moment(as_of).alias("dt_created"), F.lit(INTAKE_USER).alias("created_by"),
        moment(as_of).alias("dt_updated"), F.lit(INTAKE_USER).alias("updated_by"),
    )
    targets = (
        tables["tmp_portfolio_target"]
        .join(staged.select("portfolio_id", "account_temp_id"), "portfolio_id")
        .join(trx.select("account_temp_id"), "account_temp_id")
    )
    target = targets.select("aa_class_id", "portfolio_id", "percentage")
    return JobResult.of(tables, (), {}, {"portfolio": portfolio, "portfolio_target": target})


def copy_beneficiaries(
    tables: Tables, references: DataFrame, as_of: datetime, match_company: bool = True, traded: Traded | None = None
) -> JobResult:
    """Staged beneficiary and branch data overwrite those of the plan account.

    A reference with staged data that leads to several accounts is left out: it's
    returned in ``out['ambiguous_references']`` with its number of accounts, and a
    failure row under the step's name joins the run log. Where several staged rows
    lead to one account, the last reference and staged account win. ``traded`` is as for
    :func:`insert_portfolios`.
    """
    accounts = tables["tmp_account"]
    trx = traded.on(accounts) if traded else reuse_keys(staged_transactions(tables["trx_ut"], accounts, references))
    staged = accounts.join(trx, "account_temp_id")
    owned = traded.accounts_of(trx) if traded else accounts_of(tables, trx, match_company)
    found = reuse(owned.groupBy("reference").agg(
        F.count(F.lit(1)).alias("accounts"), F.min("acctid").alias("acctid")
    ))
    single = join_side(found.where("accounts = 1").select("reference", "acctid"), "reference")
    ambiguous = found.where("accounts > 1").select("reference", "accounts")
    source = first_per_key(
        staged.join(single, "reference"), "acctid",
        [F.col("reference").desc(), F.col("account_temp_id").desc()],
    )
    new = update_from(
        tables["plan_acct"], source, "acctid", {c: c for c in BENEFICIARY_COLUMNS},
        {"dt_updated": moment(as_of), "updated_by": F.lit(INTAKE_USER)},
    )
    failure = ambiguous.agg(F.count(F.lit(1)).alias("n"), F.min("reference").alias("first")).where("n > 0").select(
        F.lit(BENEFICIARY_STEP).alias("job"), F.lit(FAILURE).alias("status"),
        joined("references with several accounts: ", F.col("n").cast("string"), ", first ", F.col("first")).alias("error"),
    )
    rows = {"eod_log": run_log(failure, "job", "status", as_of, "error")}
    return JobResult.of(
        tables, (), {"plan_acct": new}, rows, out={"ambiguous_references": ambiguous}, touched={"plan_acct": source.select("acctid")},
    )


def staged_references(tables: Tables, since_key: int, match_company: bool = True) -> DataFrame:
    """References of new-account transactions traded since a date key whose
    staged portfolio is not live yet on some account.

    Trades are first kept to the references of staged portfolios, few next to all trades.
    """
    trx = tables["trx_ut"].where(F.col("new_account_flag") == "Y").select(
        trimmed("e_reference_number").alias("reference"), F.col("account_id").alias("account_temp_id")
    )
    trx = reuse_keys(keep_matching(trx, tables["tmp_portfolio"], "account_temp_id").select("reference").distinct())
    on = account_keys(match_company)
    trades = tables["ifsdmutrnpf"].where(changed_since(tables["ifsdmutrnpf"], "trdt", since_key)).select(trimmed("ztranref").alias("reference"), *on)
    empty = tables["plan_acct"].join(
        tables["portfolio"].select(F.col("acct_id").alias("acctid")), "acctid", "left_anti"
    )
    waiting = keep_matching(keep_matching(trades, trx, "reference").distinct(), empty, on)
    return keep_matching(trx, waiting, "reference")
