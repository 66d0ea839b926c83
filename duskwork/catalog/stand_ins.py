"""Job input tables derived from the given tables.

Orders play approvals, transactions and contracts; line items their details and
trades; customers the clients and users; suppliers the advisers; events logins
and mail. Only the few parameter and log rows are made here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.catalog.registry import Source
from duskwork.functions.text import decode
from duskwork.operators.audit import LOG_SCHEMA
from duskwork.operators.durable import reuse
from duskwork.sources.codes import PROCESS_USER

AUDIT_SCHEMA = (
    "audit_id bigint, action string, table_nm string, dt_created timestamp_ntz, created_by string, audit_type string, "
    "data1 string, data2 string"
)
AUDITED = "created_by string, dt_created timestamp_ntz, updated_by string, dt_updated timestamp_ntz"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def params(spark: SparkSession, **values: float) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in values.items()], "param_code string, value string")


def run_log(spark: SparkSession, **last: datetime) -> DataFrame:
    rows = [(name, when, "S", when, PROCESS_USER, None) for name, when in last.items()]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def client_number(key: str) -> Column:
    """Eight-character client number of a customer or supplier key."""
    return F.lpad(F.col(key).cast("string"), 8, "0")


def company() -> Column:
    return decode("o_orderstatus", [("F", "2"), ("O", "3")], "1")


def text(value: str | None = None) -> Column:
    return F.lit(value).cast("string")


def approval_tables(source: Source) -> dict[str, DataFrame]:
    orders, lines = source.orders, source.lineitem
    none = F.lit(None)
    return {
        "r_sysparam": params(source.spark, PENDINGAPPROVAL_DAYS=1500, TRX_HISTORY_DURATION_MONTH=2000),
        "pending_approval": orders.select(
            F.col("o_orderkey").alias("pending_approval_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "TRA").otherwise("ADM").alias("pending_type"),
            F.when(F.col("o_orderstatus") == "P", "PND").otherwise(F.col("o_orderstatus")).alias("pending_status"),
            F.col("o_orderpriority").alias("submitted_by"), F.col("o_orderdate").alias("dt_submitted"),
            text().alias("updated_by"), none.cast("timestamp_ntz").alias("dt_updated"),
            none.cast("bigint").alias("ref_pending_approval_id"), F.col("o_custkey").alias("next_approver_id1"),
            none.cast("bigint").alias("next_approver_id2"),
        ),
        "pending_approval_history": lines.select(
            F.col("l_orderkey").alias("pending_approval_id"), F.col("l_linenumber").cast("bigint").alias("seq"),
            F.col("l_returnflag").alias("note"),
        ),
        "trx_ut": lines.where(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("trx_ut_id"), F.col("l_orderkey").alias("pending_approval_id")
        ).distinct(),
        "trx_ut_detail": lines.select(F.col("l_orderkey").alias("trx_ut_id"), *lines.columns[1:]),
    }


def archive_tables(source: Source) -> dict[str, DataFrame]:
    tables = approval_tables(source)
    orders, lines = source.orders, source.lineitem
    tables["trx_ut"] = orders.select(
        F.col("o_orderkey").alias("trx_ut_id"), F.col("o_custkey").alias("account_id"),
        F.col("o_orderstatus").alias("trx_status"), F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("fee_stucture_type"), F.col("o_orderdate").alias("dt_created"),
    )
    tables["trx_ut_detail"] = lines.select(
        F.col("l_orderkey").alias("trx_ut_id"), F.col("l_linenumber").cast("bigint").alias("trx_ut_detail_id"),
        F.col("l_partkey").alias("fund_id"), F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("unit"),
    )
    spark = source.spark
    tables["trx_ut_hist"] = empty(
        spark, "trx_ut_id bigint, account_id bigint, trx_status string, total_amount double, "
        "fee_structure_type string, dt_created timestamp_ntz"
    )
    for name in ("trx_ut_detail", "pending_approval", "pending_approval_history"):
        tables[f"{name}_hist"] = spark.createDataFrame([], tables[name].schema)
    return tables


def user_kind() -> Column:
    return F.when(F.col("c_mktsegment") == "BUILDING", "I").otherwise("E")


def login_tables(source: Source) -> dict[str, DataFrame]:
    last = source.events.groupBy(F.col("user_id")).agg(F.max("ts").alias("dt_last_login"))
    nation, customer = source.nation, source.customer
    return {
        "r_sysparam": params(source.spark, DORMANT_PERIOD_ADMIN=0.5, DORMANT_PERIOD_USER=0.25),
        "r_user": last.select(
            "user_id", F.lit("A").alias("status"), "dt_last_login", text().alias("updated_by"),
            F.lit(None).cast("timestamp_ntz").alias("dt_updated"),
        ),
        "r_user_info": customer.select(F.col("c_custkey").alias("user_id"), user_kind().alias("user_type")),
        "r_user_role": customer.select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("role_id")
        ),
        "r_role": nation.join(source.region, nation.n_regionkey == source.region.r_regionkey).select(
            F.col("n_nationkey").cast("bigint").alias("role_id"),
            F.when(F.col("r_name") == "AFRICA", "S").otherwise("E").alias("role_type"),
        ),
    }


def mail_tables(source: Source) -> dict[str, DataFrame]:
    events = source.events
    return {
        "r_sysparam": params(
            source.spark, MAIL_MAX_DAYS_ADMIN=28, MAIL_MAX_DAYS_NON_ADMIN=27,
            MAIL_MAX_MESSAGES_ADMIN=60, MAIL_MAX_MESSAGES_NON_ADMIN=50,
        ),
        "mail": events.select(
            F.col("event_id").alias("mail_id"), F.col("user_id").alias("owner_id"),
            F.col("event_type").alias("subject"), F.col("ts").alias("dt_created"),
        ),
        "mail_dtl": events.select(F.col("event_id").alias("mail_id"), F.col("event_type").alias("attachment_id")),
        "mail_dtl_content": events.where(F.col("event_type") == "view").select(F.col("event_id").alias("mail_id")),
        "r_user_info": source.customer.select(F.col("c_custkey").alias("user_id"), user_kind().alias("user_type")),
    }


def mailing_tables(source: Source) -> dict[str, DataFrame]:
    """Templates are benchmark texts; those numbered like a region go to the
    region's customers, with the region's nations as attachments."""
    customer, nation = source.customer, source.nation
    spark = source.spark
    return {
        "mail_temp": source.benchmark.select(
            F.col("item_id").alias("mail_temp_id"), F.lit("PND").alias("status"), F.col("text").alias("message")
        ),
        "mail_temp_rcpt": customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.col("n_regionkey").cast("bigint").alias("mail_temp_id"), client_number("c_custkey").alias("clntnum")
        ),
        "mail_temp_file": nation.select(
            F.col("n_regionkey").cast("bigint").alias("mail_temp_id"),
            F.col("n_nationkey").cast("bigint").alias("attachment_id"),
        ),
        "ifsdmclntpf": customer.select(
            client_number("c_custkey").alias("clntnum"), F.col("c_name").alias("surname"),
            F.col("c_mktsegment").alias("givname"),
            F.when(F.col("c_nationkey") == 3, "CHI").otherwise("OTH").alias("race"),
        ),
        "r_user_info": customer.where(F.col("c_acctbal") > 0).select(
            F.col("c_custkey").alias("user_info_id"), F.col("c_custkey").alias("user_id"),
            client_number("c_custkey").alias("clntnum"),
        ),
        "mail": source.events.select(
            F.col("event_id").alias("mail_id"), F.col("user_id").alias("owner_id"), text().alias("from"),
            text().alias("to"), text().alias("message"), text().alias("mail_type"), F.col("event_type").alias("subject"),
            F.col("ts").alias("dt_mail"), text().alias("created_by"), F.col("ts").alias("dt_created"),
            text().alias("status"), text().alias("new_mail_flag"),
        ),
        "mail_dtl": empty(spark, "mail_id bigint, attachment_id bigint"),
    }


def client_tables(source: Source) -> dict[str, DataFrame]:
    """Customers are clients, orders contracts (joint owner: the client numbered
    like the smallest supplier of a not urgent order), customers with events
    users, suppliers in credit live advisers under ten times their own number."""
    spark, customer, orders = source.spark, source.customer, source.orders
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("datime"))
    clients = customer.join(last, customer.c_custkey == last.o_custkey)
    joint = source.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("joint"))
    contracts = orders.join(joint, orders.o_orderkey == joint.l_orderkey, "left")
    active_users = source.events.select("user_id").distinct()
    users = customer.join(active_users, customer.c_custkey == active_users.user_id)
    return {
        "eod_log": run_log(spark, NEW_AGENT=datetime(2001, 7, 6), NEW_USER=datetime(2001, 7, 6)),
        "ifsdmclntpf": clients.select(
            client_number("c_custkey").alias("clntnum"), "datime",
            F.when(F.col("c_mktsegment") == "BUILDING", "N").otherwise("Y").alias("cltmchg"),
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("   ").alias("zemailadd"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "C").otherwise("P").alias("clttype"),
        ),
        "ifsdmchdrpf": contracts.select(
            company().alias("chdrcoy"),
            F.col("o_orderkey").cast("string").alias("chdrnum"), client_number("o_custkey").alias("cownnum"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "        ")
            .otherwise(F.coalesce(client_number("joint"), F.lit("        "))).alias("jownnum"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "IF").otherwise("LA").alias("statcode"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("modidate"),
            F.when(F.col("o_orderstatus") == "F", "A").otherwise("J").alias("dueflg"),
            F.lit("1").alias("validflag"),
        ),
        "r_user": users.select(
            F.col("c_custkey").alias("user_id"), F.lit("A").alias("status"), text("N").alias("pwd_regen_flag"),
            text("N").alias("email_notify_flag"), text().alias("created_by"),
            F.lit(None).cast("timestamp_ntz").alias("dt_created"),
        ),
        "r_user_info": users.select(
            F.col("c_custkey").alias("user_info_id"), F.col("c_custkey").alias("user_id"), F.lit("E").alias("user_type"),
            client_number("c_custkey").alias("clntnum"), F.lit("A").alias("status"), text().alias("created_by"),
            F.lit(None).cast("timestamp_ntz").alias("dt_created"),
        ),
        "r_user_role": empty(spark, f"user_role_id bigint, user_id bigint, role_id bigint, status string, {AUDITED}"),
        "r_role": source.region.select(
            F.col("r_regionkey").cast("bigint").alias("role_id"),
            F.when(F.col("r_name") == "ASIA", "INVESTOR").otherwise(F.col("r_name")).alias("role_nm"),
        ),
        "ifsvwclnt_mst_ifs": customer.select(client_number("c_custkey").alias("clnt_num")),
        "ifsvwadv_mst": source.supplier.select(
            F.lpad((F.col("s_suppkey") * 10).cast("string"), 8, "0").alias("clnt_num"),
            F.when(F.col("s_acctbal") > 0, "99999999").otherwise("20010101").alias("termination_date"),
        ),
    }


def intake_tables(source: Source) -> dict[str, DataFrame]:
    """Client tables plus accounts (early orders), entities (rich users) and portfolios."""
    customer, orders = source.customer, source.orders
    users = customer.join(source.events.select("user_id").distinct(), F.col("c_custkey") == F.col("user_id"))
    return {
        **client_tables(source),
        "r_customer": users.where(F.col("c_acctbal") > 5000).select(
            F.col("c_custkey").alias("entityid"), text("IND").alias("customer_type"), text().alias("auth_type"),
            F.lit(None).cast("timestamp_ntz").alias("dt_created"), text().alias("created_by"),
        ),
        "r_custuser_matrix": users.where(F.col("c_acctbal") > 5000).select(
            F.col("c_custkey").alias("entity_id"), F.lit("JO1").alias("relationship"),
            F.col("c_custkey").alias("user_info_id"),
        ),
        "plan_acct": orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select(
            F.col("o_orderkey").alias("acctid"),
            company().alias("chdrcoy"),
            F.col("o_orderkey").cast("string").alias("chdrnum"), F.lit("A").alias("status"), F.lit(None).cast("bigint").alias("entity_id"),
            F.lit(None).cast("timestamp_ntz").alias("dt_created"), text().alias("created_by"),
            F.lit(None).cast("timestamp_ntz").alias("dt_updated"), text().alias("updated_by"),
            *[text().alias(c) for c in _beneficiary()],
        ),
        **portfolio_tables(source),
    }


def _beneficiary() -> tuple[str, ...]:
    from duskwork.plans.portfolios import BENEFICIARY_COLUMNS

    return BENEFICIARY_COLUMNS


def portfolio_tables(source: Source) -> dict[str, DataFrame]:
    """Line items are trades on the contract of their order under a reference
    made of part and supplier; parts of brand 1 have staged portfolios."""
    lines = source.lineitem
    reference = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    orders = source.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        company().alias("chdrcoy"),
    )
    part = source.part
    return {
        "ifsdmutrnpf": lines.join(orders, "l_orderkey").select(
            F.concat(reference, F.lit("  ")).alias("ztranref"), "chdrcoy",
            F.col("l_orderkey").cast("string").alias("chdrnum"),
            F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("trdt"),
        ),
        "trx_ut": lines.select(
            F.concat(F.lit(" "), reference).alias("e_reference_number"), F.col("l_partkey").alias("account_id"),
            F.lit("Y").alias("new_account_flag"),
        ),
        "tmp_portfolio": part.where(F.col("p_brand") == "Brand#1").select(
            F.col("p_partkey").alias("portfolio_id"), F.col("p_partkey").alias("account_temp_id"),
            F.col("p_type").alias("risk_category_nm"), F.col("p_retailprice").alias("exp_return"),
            F.lit("A").alias("status"), F.col("p_size").cast("bigint").alias("portfolio_model_id"),
            text().alias("portfolio_builder_type"),
        ),
        "tmp_portfolio_target": part.select(
            F.col("p_size").cast("bigint").alias("aa_class_id"), F.col("p_partkey").alias("portfolio_id"),
            F.col("p_retailprice").alias("percentage"),
        ),
        "tmp_account": part.select(
            F.col("p_partkey").alias("account_temp_id"), *[text().alias(c) for c in _beneficiary()]
        ),
        "portfolio": empty(
            source.spark, "portfolio_id bigint, risk_category_nm string, exp_return double, status string, "
            f"acct_id bigint, portfolio_model_id bigint, portfolio_builder_type string, {AUDITED}"
        ),
        "portfolio_target": empty(source.spark, "aa_class_id bigint, portfolio_id bigint, percentage double"),
    }


def reset_tables(source: Source) -> dict[str, DataFrame]:
    """Users with a large signup are asked to reset; early buyers are queued."""
    events, customer = source.events, source.customer
    users = events.groupBy("user_id").agg(
        F.max((F.col("event_type") == "signup") & (F.col("value") > 60)).alias("asked")
    )
    return {
        "r_sysparam": params(source.spark, PASSWORD_RESET_DATE_LAST_RUN=20240101),
        "r_user": users.select(
            "user_id", F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login_id"),
            F.when(F.col("asked"), "Y").otherwise("N").alias("pwd_regen_flag"),
        ),
        "r_user_info": customer.select(
            F.col("c_custkey").alias("user_info_id"), F.col("c_custkey").alias("user_id"),
            client_number("c_custkey").alias("clntnum"),
        ),
        "ifsdmclntpf": customer.select(
            client_number("c_custkey").alias("clntnum"), F.col("c_name").alias("zemailadd"),
            F.col("c_mktsegment").alias("cltaddr01"),
            *[text().alias(f"cltaddr0{i}") for i in range(2, 6)],
        ),
        "r_user_process": events.where(
            (F.col("event_type") == "purchase") & (F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz"))
        ).select("user_id").distinct().select(
            F.col("user_id").cast("string").alias("user_id"), text().alias("login_id"), text().alias("email"),
            text().alias("genpass"), *[text().alias(f"cltaddr0{i}") for i in range(1, 6)],
        ),
    }


# Tables of a night that joins or groupings of the given ones make: each of its jobs reads them, some several times.
NIGHT_DERIVED = (
    "ifsdmclntpf", "ifsdmchdrpf", "ifsdmutrnpf", "ifsdmaglfpf", "r_user", "r_user_info", "r_customer",
    "r_custuser_matrix", "r_user_process",
)


def written_once(tables: dict[str, DataFrame], names: tuple[str, ...]) -> dict[str, DataFrame]:
    """The tables, the named ones as written files, so that no reader joins or groups the given tables again."""
    return {**tables, **{n: reuse(tables[n]) for n in names}}


def night_tables(source: Source) -> dict[str, DataFrame]:
    """Intake, refresh and reset tables of one world: those of the intake, where some users
    are inactive, agents and serving agents as for the refresh, and the queue of early buyers."""
    spark, customer = source.spark, source.customer
    tables, refresh = intake_tables(source), refresh_tables(source)
    none = F.lit(None)
    balance = customer.select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    moments = [none.cast("timestamp_ntz").alias(c) for c in ("dt_updated", "dt_reset_password_updated")]
    tables["r_user"] = tables["r_user"].drop("status").join(balance, "user_id").select(
        "user_id", F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login_id"),
        F.when(F.col("c_acctbal") < 0, "I").otherwise("A").alias("status"), "pwd_regen_flag", "email_notify_flag",
        "created_by", "dt_created", text().alias("updated_by"), *moments,
    )
    addresses = customer.select(client_number("c_custkey").alias("clntnum"), F.col("c_mktsegment").alias("cltaddr01"))
    tables["ifsdmclntpf"] = tables["ifsdmclntpf"].join(addresses, "clntnum").select(
        "*", *[text().alias(f"cltaddr0{i}") for i in range(2, 6)])
    served = refresh["ifsdmchdrpf"].select("chdrcoy", "chdrnum", "servagnt")
    tables["ifsdmchdrpf"] = tables["ifsdmchdrpf"].join(served, ["chdrcoy", "chdrnum"])
    tables["r_role"] = source.region.select(
        F.col("r_regionkey").cast("bigint").alias("role_id"), decode("r_name", [("ASIA", "INVESTOR")], F.col("r_name")).alias("role_nm"),
        decode("r_name", [("ASIA", "I"), ("EUROPE", "V")], "M").alias("role_type"),
    )
    marks = run_log(spark, NEW_AGENT=datetime(2001, 7, 6), NEW_USER=datetime(2001, 7, 6))
    return {
        **tables,
        **{n: refresh[n] for n in ("ifsdmaglfpf", "r_agt_cl_role_map")},
        "r_user_process": reset_tables(source)["r_user_process"],
        "r_sysparam": params(spark, PASSWORD_RESET_DATE_LAST_RUN=20240101),
        "eod_log": marks,
        "audit_trail": empty(spark, AUDIT_SCHEMA),
    }


def housekeeping_tables(source: Source) -> dict[str, DataFrame]:
    """Approvals, transactions with details, mail and logins of one world: orders with a
    returned line are transactions on their own approval."""
    spark, orders, lines = source.spark, source.orders, source.lineitem
    returned = lines.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    trx = orders.join(returned, "o_orderkey").select(
        F.col("o_orderkey").alias("trx_ut_id"), F.col("o_orderkey").alias("pending_approval_id"),
        F.col("o_orderkey").cast("string").alias("reference_id"),
        F.when(F.col("o_custkey") % 2 == 0, "ORD").otherwise("NEW").alias("trx_status"),
        F.col("o_orderpriority").alias("fee_stucture_type"), F.col("o_orderdate").alias("dt_created"),
    )
    approvals = approval_tables(source)
    detail = lines.select(F.col("l_orderkey").alias("trx_ut_id"), F.col("l_linenumber").cast("bigint").alias("trx_ut_detail_id"))
    kept = {n: approvals[n] for n in ("pending_approval", "pending_approval_history")}
    fee = {"fee_stucture_type": "fee_structure_type"}
    return {
        **kept, "trx_ut": trx, "trx_ut_detail": detail,
        "trx_ut_hist": spark.createDataFrame([], trx.schema).withColumnsRenamed(fee),
        **{f"{n}_hist": spark.createDataFrame([], df.schema) for n, df in {**kept, "trx_ut_detail": detail}.items()},
        "ifsdmutrnpf": lines.select(
            F.rpad(F.col("l_orderkey").cast("string"), 16, " ").alias("ztranref"),
            F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("fdbkind"),
        ),
        **{n: df for n, df in mail_tables(source).items() if n.startswith("mail")},
        **{n: df for n, df in login_tables(source).items() if n.startswith("r_") and n != "r_sysparam"},
        "r_sysparam": params(
            spark, PENDINGAPPROVAL_DAYS=9500, TRX_HISTORY_DURATION_MONTH=10000, DORMANT_PERIOD_ADMIN=0.5, DORMANT_PERIOD_USER=0.25,
            MAIL_MAX_DAYS_ADMIN=28, MAIL_MAX_DAYS_NON_ADMIN=27, MAIL_MAX_MESSAGES_ADMIN=60, MAIL_MAX_MESSAGES_NON_ADMIN=50,
        ),
        "eod_log": empty(spark, LOG_SCHEMA), "audit_trail": empty(spark, AUDIT_SCHEMA),
    }


def entity_tables(source: Source) -> dict[str, DataFrame]:
    """Orders are entities; the suppliers of their lines 1 and 2 first and second owners."""
    lines = source.lineitem.where(F.col("l_linenumber").isin(1, 2))
    return {
        "r_custuser_matrix": lines.select(
            F.col("l_orderkey").alias("entity_id"),
            F.when(F.col("l_linenumber") == 1, "JO1").otherwise("JO2").alias("relationship"),
            F.col("l_suppkey").alias("user_info_id"),
        ),
        "r_user_info": source.supplier.select(
            F.col("s_suppkey").alias("user_info_id"), client_number("s_suppkey").alias("clntnum")
        ),
    }


def refresh_tables(source: Source) -> dict[str, DataFrame]:
    """Customers are users; orders say which roles they hold; suppliers are
    agents of the customer numbered ten times their own key, in their nation's
    region's role; orders are contracts served by their smallest supplier."""
    spark, customer, orders = source.spark, source.customer, source.orders
    agents = source.supplier.join(source.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        source.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    lowest = source.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("lowest"))
    contracts = orders.join(lowest, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    role = decode("o_orderstatus", [("F", 2), ("O", 3)], 0).cast("bigint")
    none = F.lit(None)
    return {
        "eod_log": empty(spark, LOG_SCHEMA),
        "r_user": customer.select(
            F.col("c_custkey").alias("user_id"),
            decode("c_mktsegment", [("BUILDING", "I"), ("MACHINERY", "R")], "A").alias("status"),
            text("N").alias("pwd_regen_flag"), text().alias("updated_by"), none.cast("timestamp_ntz").alias("dt_updated"),
            none.cast("timestamp_ntz").alias("dt_reset_password_updated"),
        ),
        "r_user_info": customer.select(
            F.col("c_custkey").alias("user_info_id"), F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "I").otherwise("E").alias("user_type"),
            client_number("c_custkey").alias("clntnum"),
        ),
        "ifsdmclntpf": customer.select(
            client_number("c_custkey").alias("clntnum"),
            F.when(F.col("c_acctbal") < 0, "N").otherwise("Y").alias("cltmchg"),
        ),
        "ifsdmaglfpf": agents.select(
            F.lpad((F.col("s_suppkey") * 10).cast("string"), 8, "0").alias("clntnum"),
            F.col("s_suppkey").cast("string").alias("agntnum"),
            F.when(F.col("s_nationkey") < 12, "2").otherwise("3").alias("agntcoy"), F.col("r_name").alias("zlfagtcl"),
            F.when(F.col("s_acctbal") > 3000, 99999999).otherwise(20010101).alias("dtetrm"),
        ),
        "r_role": source.region.select(
            F.col("r_regionkey").cast("bigint").alias("role_id"), F.col("r_name").alias("role_nm"),
            decode("r_name", [("ASIA", "V"), ("EUROPE", "I")], "M").alias("role_type"),
        ),
        "r_agt_cl_role_map": source.region.select(
            F.col("r_name").alias("zlfagtcl"), F.col("r_regionkey").cast("bigint").alias("role_id")
        ),
        "v_userrole": orders.select(F.col("o_custkey").alias("user_id"), role.alias("role_id")),
        "r_user_role": orders.where(F.col("o_orderstatus") == "O").select(
            F.col("o_custkey").alias("user_id"), role.alias("role_id")
        ),
        "ifsdmchdrpf": contracts.select(
            company().alias("chdrcoy"), F.col("o_orderkey").cast("string").alias("chdrnum"),
            client_number("o_custkey").alias("cownnum"), client_number("lowest").alias("jownnum"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "IF").otherwise("LA").alias("statcode"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("modidate"),
            F.col("lowest").cast("string").alias("servagnt"),
        ),
        "plan_acct": orders.select(
            F.col("o_orderkey").alias("acctid"), company().alias("chdrcoy"),
            F.col("o_orderkey").cast("string").alias("chdrnum"),
            F.when(F.col("o_totalprice") > 250000, "I").otherwise("A").alias("status"), text().alias("updated_by"),
            none.cast("timestamp_ntz").alias("dt_updated"),
        ),
    }


def note_tables(source: Source) -> dict[str, DataFrame]:
    """Part brands are coverage codes, order priorities payment frequencies; item
    codes are built from brands and priorities of parts and orders."""
    part, orders = source.part, source.orders
    brand = F.concat(F.lit("B"), F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)))
    frequency = F.substring("o_orderpriority", 1, 1)
    by_frequency = orders.select(
        F.concat(F.lit("EX"), frequency, F.substring("o_orderstatus", 1, 1), F.lit("1")).alias("itemitem")
    ).distinct()
    generic = part.select(
        F.concat(F.lit("EX**"), F.when(F.col("p_size") > 25, "F").otherwise("-"), F.substring("p_type", 1, 2)).alias("itemitem")
    ).distinct()
    item = [F.lit("IT").alias("itempfx"), F.lit("1").alias("itemcoy"), "itemitem",
            F.concat(F.lit(" "), F.col("itemitem")).alias("longdesc"),
            F.concat(F.lit("text of "), F.col("itemitem"), F.lit("  ")).alias("trandesc")]
    return {
        "ifsdmcovrpf": part.select(
            brand.alias("crtable"), F.lit("2").alias("chdrcoy"), F.lit("01").alias("coverage"), F.lit("00").alias("rider"),
            F.when(F.col("p_size") > 10, "1").otherwise("2").alias("validflag"),
        ),
        "ifsdmcovtpf": part.where(F.col("p_size") <= 10).select(
            brand.alias("crtable"), F.lit("3").alias("chdrcoy"), F.lit("01").alias("coverage"), F.lit("00").alias("rider")
        ),
        "ifsdmt3590": orders.select(F.rpad(frequency, 8, " ").alias("itemitem")),
        "ifsdmt5687": part.groupBy("p_brand").agg(F.max("p_retailprice").alias("top")).select(
            F.lit("1").alias("itemcoy"), F.rpad(brand, 8, " ").alias("itemitem"), F.lit("99999999").alias("itmto"),
            F.when(F.col("top") > 1000, "F").otherwise("O").alias("sp_ind"),
        ),
        "ifsdmt9065": by_frequency.select(*item).union(generic.select(*item)),
        "r_explanatory_notes": part.select(
            F.lit("1").alias("chdrcoy"), F.lit("1").alias("billfreq"), brand.alias("crtable"),
            F.lit("EX1F1").alias("noteitem"), F.lit("old").alias("notedesc"),
        ).distinct(),
    }


def description_tables(source: Source) -> dict[str, DataFrame]:
    """Line items are unit balances and trades of the contract of their order;
    item codes come from parts, suppliers and orders."""
    orders, lines = source.orders, source.lineitem
    coy = orders.select(F.col("o_orderkey").alias("l_orderkey"), company().alias("chdrcoy"))
    trades = lines.join(coy, "l_orderkey").select(
        "chdrcoy", F.col("l_orderkey").cast("string").alias("chdrnum"), F.col("l_partkey").cast("string").alias("vrtfnd"),
        F.col("l_returnflag").alias("unityp"), F.concat(F.lit("T"), F.col("l_linestatus")).alias("batctrcde"),
        F.concat(F.lit("S"), F.col("l_linenumber").cast("string")).alias("sacstyp"),
    )
    batch_item = F.concat(
        F.lit("xT"), F.col("l_linestatus"), F.lit("S"), F.col("l_linenumber").cast("string"), F.col("l_returnflag")
    )
    any_item = F.concat(F.lit("****S"), F.col("l_linenumber").cast("string"), F.col("l_returnflag"))
    pointers = orders.select(
        F.concat(F.lit("T"), F.substring("o_orderstatus", 1, 1), F.lit("C"), F.substring("o_orderpriority", 1, 1), F.lit("A"))
        .alias("itemitem")
    ).distinct()
    codes = lambda df, code: df.select(code.alias("itemitem")).distinct()
    head = [F.lit("IT").alias("itempfx"), F.lit("2").alias("itemcoy"), "itemitem"]
    described = codes(lines, batch_item).union(codes(lines, any_item)).union(codes(source.region, F.lit("TARGET77")))
    target = F.concat(F.rpad(F.lit("nothing here"), 78 * 7, "."), F.rpad(F.lit("TARGET77 TFS1"), 78, "."))
    return {
        "ifsdmchdrpf": orders.select(
            company().alias("chdrcoy"), F.col("o_orderkey").cast("string").alias("chdrnum"),
            F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("cnttype"),
        ),
        "ifsdmlzubpf": trades.select("chdrcoy", "chdrnum", "vrtfnd", "unityp"),
        "ifsdmutrnpf": trades.drop("unityp"),
        "ifsdmlzsdpf": trades.where(F.col("unityp") == "N").select("chdrcoy", "chdrnum", F.lit("Z").alias("unityp"), "batctrcde", "sacstyp"),
        "ifsdmt9065": described.select(*head, F.lit("").alias("longdesc"), F.concat(F.lit("text of "), F.col("itemitem")).alias("trandesc"))
        .union(pointers.select(*head, F.lit("").alias("longdesc"), target.alias("trandesc"))),
        "ifsdmt1688": source.region.where(F.col("r_name") == "ASIA").select(
            F.lit("IT").alias("itempfx"), F.lit("2").alias("itemcoy"), F.lit("TO").alias("itemitem"), F.col("r_name").alias("longdesc")
        ),
        "r_trx_description": orders.select(
            F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("cnttype"), F.lit("A").alias("unityp"),
            F.lit("TF").alias("batctrcde"), F.lit("S7").alias("sacstyp"), F.lit("old").alias("trandesc"),
        ).distinct(),
    }


def beneficiary_tables(source: Source) -> dict[str, DataFrame]:
    """Each customer has one contract and account; each order is a reference to
    it, and the parts of its lines are the staged accounts."""
    lines, orders, customer = source.lineitem, source.orders, source.customer
    two = F.lit("2").alias("chdrcoy")
    number = F.col("c_custkey").cast("string").alias("chdrnum")
    staged = {"beneficial_name": F.col("p_name"), "branch_name": F.col("p_brand")}
    return {
        "eod_log": empty(source.spark, LOG_SCHEMA),
        "trx_ut": lines.select(
            client_number("l_orderkey").alias("e_reference_number"), F.col("l_partkey").alias("account_id")
        ),
        "ifsdmutrnpf": orders.select(
            F.rpad(client_number("o_orderkey"), 10, " ").alias("ztranref"), two,
            F.col("o_custkey").cast("string").alias("chdrnum"),
        ),
        "ifsdmchdrpf": customer.select(two, number),
        "plan_acct": customer.select(
            F.col("c_custkey").alias("acctid"), two, number, *[text().alias(c) for c in _beneficiary()],
            text().alias("updated_by"), F.lit(None).cast("timestamp_ntz").alias("dt_updated"),
        ),
        "tmp_account": source.part.select(
            F.col("p_partkey").alias("account_temp_id"), *[staged.get(c, text()).alias(c) for c in _beneficiary()]
        ),
    }
