from datetime import datetime

import pytest
from pyspark.sql import functions as F

from duskwork import plans
from duskwork.plans import alerts, intake, portfolios
from duskwork.plans.entities import get_entities
from duskwork.sources.params import param
from tests.helpers import AS_OF, ago, money, params, rows, tables


def audit_of(result):
    return rows(result.audit, "action", "table_nm", "data1", "data2")


# --- approvals ---------------------------------------------------------------

def approval_case(spark):
    pa = [
        {"pending_approval_id": 1, "pending_type": "TRA", "pending_status": "PND", "dt_submitted": ago(30), "submitted_by": "u"},
        {"pending_approval_id": 2, "pending_type": "ADM", "pending_status": "PND", "dt_submitted": ago(30)},
        {"pending_approval_id": 3, "pending_type": "TRA", "pending_status": "PND", "dt_submitted": ago(30)},
        {"pending_approval_id": 4, "pending_type": "ADM", "pending_status": "PND", "dt_submitted": ago(30, -1)},
        {"pending_approval_id": 5, "pending_type": "ADM", "pending_status": "APP", "dt_submitted": ago(99)},
        {"pending_approval_id": 6, "pending_type": None, "pending_status": "PND", "dt_submitted": ago(99)},
        {"pending_approval_id": 7, "pending_type": "ADM", "pending_status": "PND", "dt_submitted": None},
        {"pending_approval_id": 8, "pending_type": "ADM", "pending_status": "PND", "dt_submitted": ago(40)},
    ]
    return tables(
        spark, r_sysparam=params(PENDINGAPPROVAL_DAYS=30), pending_approval=pa,
        trx_ut=[{"trx_ut_id": 10, "pending_approval_id": 1}, {"trx_ut_id": 80, "pending_approval_id": 8},
                {"trx_ut_id": 81, "pending_approval_id": 8}, {"trx_ut_id": 50, "pending_approval_id": 5},
                {"trx_ut_id": 51, "pending_approval_id": None}],
        trx_ut_detail=[{"trx_ut_detail_id": i, "trx_ut_id": t} for i, t in ((1, 10), (2, 80), (3, 81), (4, 50), (5, None))],
        pending_approval_history=[{"pending_approval_id": i} for i in (1, 2, 8, None)],
    )


def test_expire_approvals(spark):
    t = approval_case(spark)
    r = plans.expire_approvals(t, AS_OF)
    assert rows(r.tables["pending_approval"], "pending_approval_id", "pending_status") == [
        (2, "EXP"), (3, "PND"), (4, "PND"), (5, "APP"), (6, "PND"), (7, "PND")
    ]
    assert rows(r.tables["trx_ut"], "trx_ut_id") == [(50,), (51,)]
    assert rows(r.tables["trx_ut_detail"], "trx_ut_detail_id") == [(4,), (5,)]
    assert rows(r.tables["pending_approval_history"], "pending_approval_id") == [(2,), (None,)]
    assert audit_of(r) == [
        ("EOD4.1", "PENDING_APPROVAL", "1|TRA|PND|u|2024-05-16 12:00:00|||||", None),
        ("EOD4.1", "PENDING_APPROVAL", "2|ADM|PND||2024-05-16 12:00:00|||||",
         "2|ADM|EXP||2024-05-16 12:00:00||2024-06-15 12:00:00|||"),
        ("EOD4.1", "PENDING_APPROVAL", "8|ADM|PND||2024-05-06 12:00:00|||||", None),
    ]
    again = plans.expire_approvals(r.over(t), AS_OF)
    for name, df in again.tables.items():
        assert rows(df) == rows(r.tables[name])
    assert again.audit.count() == 0


# --- mailboxes -----------------------------------------------------------------

def test_purge_mailboxes(spark):
    mail = [{"mail_id": i, "owner_id": 1, "dt_created": ago(i), "subject": f"s{i}"} for i in range(1, 6)]
    mail += [{"mail_id": 6, "owner_id": 1, "dt_created": ago(3)}, {"mail_id": 7, "owner_id": 1, "dt_created": None}]
    mail += [{"mail_id": 20 + i, "owner_id": 2, "dt_created": ago(i)} for i in range(1, 6)]
    mail += [{"mail_id": 30, "owner_id": 2, "dt_created": ago(10)}, {"mail_id": 31, "owner_id": 2, "dt_created": ago(10, -1)}]
    mail += [{"mail_id": 40, "owner_id": 9, "dt_created": ago(999)}, {"mail_id": 41, "owner_id": None, "dt_created": ago(999)}]
    t = tables(
        spark, mail=mail, mail_dtl=[{"mail_id": i, "attachment_id": 1} for i in (1, 5, 30)],
        mail_dtl_content=[{"mail_id": i} for i in (2, 4)],
        r_user_info=[{"user_id": 1, "user_type": "I"}, {"user_id": 2, "user_type": "E"}, {"user_id": 2, "user_type": None}],
        r_sysparam=params(MAIL_MAX_DAYS_ADMIN=100, MAIL_MAX_MESSAGES_ADMIN=4, MAIL_MAX_DAYS_NON_ADMIN=10,
                          MAIL_MAX_MESSAGES_NON_ADMIN=6),
    )
    r = plans.purge_mailboxes(t, AS_OF)
    # owner 1: day 3 twice, four newer than day 4; owner 2: exactly ten days is too old
    gone = {4, 5, 30}
    kept = {m["mail_id"] for m in mail} - gone
    assert {m for (m,) in rows(r.tables["mail"], "mail_id")} == kept
    assert rows(r.tables["mail_dtl"], "mail_id") == [(1,)]
    assert rows(r.tables["mail_dtl_content"], "mail_id") == [(2,)]
    assert ("DeleteMB", "MAIL,MAIL.DTL", "4|2024-06-11 12:00:00|s4", None) in audit_of(r) and r.audit.count() == 3
    assert plans.purge_mailboxes(r.over(t), AS_OF).tables["mail"].count() == len(kept)


def test_annual_report(spark):
    t = tables(
        spark, mail=[{"mail_id": 100}],
        mail_temp=[{"mail_temp_id": 1, "status": "PND", "message": "m1"}, {"mail_temp_id": 2, "status": "CMP", "message": "m2"},
                   {"mail_temp_id": 3, "status": "PND", "message": "m3"}],
        mail_temp_rcpt=[{"mail_temp_id": 1, "clntnum": c} for c in ("A", "B       ", "X", "Y")] + [{"mail_temp_id": 2, "clntnum": "A"}],
        mail_temp_file=[{"mail_temp_id": 1, "attachment_id": 7}, {"mail_temp_id": 1, "attachment_id": 8}],
        ifsdmclntpf=[{"clntnum": "A", "race": "CHI", "surname": "Tan ", "givname": "Mei"},
                     {"clntnum": "B", "race": "MAL", "surname": "Ali", "givname": "Nur"},
                     {"clntnum": "X", "surname": "No", "givname": "User"}],
        r_user_info=[{"user_info_id": 2, "user_id": 12, "clntnum": "A"}, {"user_info_id": 1, "user_id": 11, "clntnum": "A"},
                     {"user_info_id": 3, "user_id": 13, "clntnum": "B"}, {"user_info_id": 4, "user_id": 14, "clntnum": "Y"}],
    )
    r = plans.mail_annual_report(t, AS_OF)
    new = r.tables["mail"].where("mail_id > 100")
    assert set(rows(new, "owner_id", "to", "message", "subject")) == {
        (11, "Tan Mei", "m1", "Fund Information"), (13, "Nur Ali", "m1", "Fund Information")
    }
    ids = [m for (m,) in rows(new, "mail_id")]
    assert ids == [101, 102]
    assert rows(r.tables["mail_dtl"]) == [(101, 7), (101, 8), (102, 7), (102, 8)]
    assert rows(r.tables["mail_temp"], "mail_temp_id", "status") == [(1, "CMP"), (2, "CMP"), (3, "CMP")]
    assert rows(r.out["skipped"]) == [(1, 2)]


# --- alerts --------------------------------------------------------------------

def test_alerts(spark):
    t = tables(
        spark,
        fund_alert=[{"fund_alert_id": i, "user_id": i, "floor": money(lo), "ceiling": money(hi)}
                    for i, lo, hi in ((1, 5, 9), (2, 5, 9), (3, 5, 9), (4, None, 9), (5, 5, 9))],
        ifsdmvprcpf=[{"vrtfnd": v, "effdate": d, "ubidpr": money(p)} for v, d, p in (
            ("1", 20240101, 1), ("1", 20240102, 7), ("2", 20240102, 5), ("2", 20240102, 9), ("3", 20240103, 7),
            ("4", 20240101, 9), ("5", None, 1))],
        acct_alert=[{"acct_id": 1, "user_id": 1, "floor": money(5), "ceiling": money(9)}],
        account_value=[{"acct_id": 1, "effdate": 20240101, "ubidpr": money(1)}],
    )
    r = plans.alert_by_fund(t, AS_OF)
    assert [(a, float(p)) for a, p in rows(r.out["alerts"], "fund_alert_id", "ubidpr")] == [(2, 5.0), (2, 9.0), (4, 9.0)]
    assert rows(plans.alert_by_account(t, AS_OF).out["alerts"], "acct_id") == [(1,)]
    assert alerts.FUND_LOG_NAME == "AlertByFund"


# --- archive -------------------------------------------------------------------

def test_archive(spark):
    t = tables(
        spark, r_sysparam=params(TRX_HISTORY_DURATION_MONTH=90),
        trx_ut=[{"trx_ut_id": 1, "dt_created": ago(90), "fee_stucture_type": "F"}, {"trx_ut_id": 2, "dt_created": ago(90, -1)},
                {"trx_ut_id": 3, "dt_created": None}],
        trx_ut_detail=[{"trx_ut_detail_id": i, "trx_ut_id": t} for i, t in ((1, 1), (2, 1), (3, 2), (4, None))],
        pending_approval=[{"pending_approval_id": 1, "pending_type": "TRA", "dt_submitted": ago(91)},
                          {"pending_approval_id": 2, "pending_type": "ADM", "dt_submitted": ago(91)},
                          {"pending_approval_id": 3, "pending_type": "TRA", "dt_submitted": ago(1)}],
        pending_approval_history=[{"pending_approval_id": i, "seq": s} for i, s in ((1, 1), (1, 2), (2, 1))],
    )
    r = plans.archive_transactions(t, AS_OF)
    n = r.tables
    assert rows(n["trx_ut_hist"], "trx_ut_id", "fee_structure_type") == [(1, "F")]
    assert rows(n["trx_ut"], "trx_ut_id") == [(2,), (3,)]
    assert rows(n["trx_ut_detail_hist"], "trx_ut_detail_id") == [(1,), (2,)]
    assert rows(n["trx_ut_detail"], "trx_ut_detail_id") == [(3,), (4,)]
    assert rows(n["pending_approval_hist"], "pending_approval_id") == [(1,)]
    assert rows(n["pending_approval_history_hist"], "seq") == [(1,), (2,)]
    assert rows(n["pending_approval_history"], "pending_approval_id") == [(2,)]
    audit = audit_of(r)
    assert ("HkpTrnHist", "TRX_UT", "TRX_UT 1", "TRX_UT_HIST 1") in audit
    assert ("HkpTrnHist", "PENDING_APPROVAL", "PENDING_APPROVAL 1", "PENDING_APPROVAL_HIST 1") in audit
    assert len(audit) == 2 + 1 + 2 + 1
    again = plans.archive_transactions(r.over(t), AS_OF)
    assert all(rows(df) == rows(n[name]) for name, df in again.tables.items())


# --- users ---------------------------------------------------------------------

def test_dormant(spark):
    user = lambda i, days, status="A": {"user_id": i, "status": status, "dt_last_login": days if days is None else ago(days)}
    t = tables(
        spark, r_sysparam=params(DORMANT_PERIOD_USER=30, DORMANT_PERIOD_ADMIN=60),
        r_user=[user(1, 30), user(2, 30), user(3, 60), user(4, 99, "D"), user(5, 99), user(6, 99), user(7, None), user(8, 99, None), user(9, 99)],
        r_user_info=[{"user_id": i, "user_type": k} for i, k in ((1, "E"), (2, "I"), (3, "I"), (4, "E"), (5, "E"), (6, "E"), (7, "E"), (8, "E"))],
        r_user_role=[{"user_id": i, "role_id": r} for i, r in ((1, 1), (2, 1), (3, 1), (3, 2), (4, 1), (5, 9), (6, 1), (6, 9), (7, 1), (8, 1), (9, 1))],
        r_role=[{"role_id": 1, "role_type": "E"}, {"role_id": 2, "role_type": "V"}, {"role_id": 9, "role_type": "S"}],
    )
    r = plans.set_dormant(t, AS_OF)
    now = {i: (s, b) for i, s, b in rows(r.tables["r_user"], "user_id", "status", "updated_by")}
    assert {i for i, (s, b) in now.items() if b == "EOD_PROCESS"} == {1, 3, 6}
    assert now[1][0] == "D" and now[2][0] == "A" and now[5][0] == "A"
    assert audit_of(r)[0] == ("DormantUID", "R_USER", "1|A", "1|D") and r.audit.count() == 3


def test_password_resets(spark):
    t = tables(
        spark, r_sysparam=params(PASSWORD_RESET_DATE_LAST_RUN=1, OTHER=2),
        r_user=[{"user_id": i, "login_id": f"l{i}", "pwd_regen_flag": f} for i, f in ((1, "Y"), (2, "Y"), (3, "N"), (4, "Y"), (5, None))],
        r_user_info=[{"user_info_id": 10 + i, "user_id": i, "clntnum": f"C{i}      "} for i in (1, 2, 3, 5)],
        ifsdmclntpf=[{"clntnum": f"C{i}", "zemailadd": f"m{i}", "cltaddr01": "a"} for i in (1, 2, 3, 4, 5)],
        r_user_process=[{"user_id": "2", "login_id": "old"}],
    )
    r = plans.queue_password_resets(t, AS_OF)
    assert rows(r.tables["r_user_process"], "user_id", "login_id", "email", "cltaddr01") == [("1", "l1", "m1", "a"), ("2", "old", None, None)]
    assert rows(r.tables["r_user"], "user_id", "pwd_regen_flag") == [(1, "N"), (2, "N"), (3, "N"), (4, "Y"), (5, None)]
    assert param(r.tables["r_sysparam"], "PASSWORD_RESET_DATE_LAST_RUN") == "20241506"
    assert param(r.tables["r_sysparam"], "OTHER") == "2"
    assert audit_of(r) == [("ResetPW", "R_USER", "1|Y", "1|N"), ("ResetPW", "R_USER", "2|Y", "2|N")]
    t["r_sysparam"] = t["r_sysparam"].where("param_code = 'OTHER'")
    with pytest.raises(LookupError):
        plans.queue_password_resets(t, AS_OF)


def test_settlement(spark):
    trx = [{"trx_ut_id": i, "trx_status": s, "reference_id": ref} for i, s, ref in (
        (1, "ORD", "none"), (2, "ORD", "y"), (3, "ORD", "mixed"), (4, "ORD", "null"), (5, "NEW", "y"), (6, "ORD", None), (7, None, "y"))]
    t = tables(spark, trx_ut=trx, ifsdmutrnpf=[
        {"ztranref": " y  ", "fdbkind": "Y"}, {"ztranref": "mixed ", "fdbkind": "Y"}, {"ztranref": "mixed", "fdbkind": "N"},
        {"ztranref": "null", "fdbkind": None}, {"ztranref": "   ", "fdbkind": "N"}])
    r = plans.settle_transactions(t, AS_OF)
    assert rows(r.tables["trx_ut"], "trx_ut_id", "trx_status") == [
        (1, "SUC"), (2, "SUC"), (3, "ORD"), (4, "SUC"), (5, "NEW"), (6, "SUC"), (7, None)
    ]
    assert audit_of(r)[0] == ("TrxApp", "TRX_UT", "1|ORD", "1|SUC") and r.audit.count() == 4


# --- intake ----------------------------------------------------------------------

def intake_case(spark, **more):
    client = lambda c, **k: {"clntnum": c, "datime": ago(1), "cltmchg": "Y", **k}
    base = dict(
        eod_log=[{"eod_proc_name": "NEW_AGENT", "eod_date": ago(10), "status": "S"}],
        r_role=[{"role_id": 5, "role_nm": "INVESTOR", "role_type": "I"}, {"role_id": 6, "role_nm": "X", "role_type": "V"}],
        r_user=[{"user_id": 100, "status": "A"}],
        r_user_info=[{"user_info_id": 200, "user_id": 100, "clntnum": "OLD     "}],
        r_user_role=[{"user_role_id": 300, "user_id": 100, "role_id": 6}],
        ifsdmclntpf=[
            client("AGT     ", zemailadd="a@b"), client("AGT", zemailadd="  ", datime=ago(2)), client("GONE"), client("OLD"),
            client("STALE", datime=ago(15)), client("OFF", cltmchg="N"), client(None),
            client("INV1", zemailadd="x"), client("INV2", cltmchg=None), client("INV3", cltmchg="N"), client("NOPE"),
            client("CORP", clttype="C"),
        ],
        ifsvwclnt_mst_ifs=[{"clnt_num": c} for c in ("AGT", "GONE", "OLD", "STALE", "OFF")],
        ifsvwadv_mst=[{"clnt_num": c, "termination_date": d} for c, d in (
            ("AGT", "99999999"), ("GONE", "20240615"), ("OLD", "99999999"), ("STALE", "99999999"), ("OFF", "99999999"))],
        ifsdmchdrpf=[
            {"chdrcoy": c, "chdrnum": n, "cownnum": m, "jownnum": j, "statcode": s, "modidate": 20240610, "dueflg": d, "validflag": "1"}
            for c, n, m, j, s, d in (
                ("2", "K1", "INV1    ", "INV2    ", "IF", "A"), ("3", "K2", "INV1", "        ", "AC", None),
                ("2", "K3", "INV1", "INV2", "IF", "J"), ("2", "K4", "INV3", None, "AC", None), ("1", "K5", "NOPE", None, "IF", None),
                ("2", "K6", "NOPE", None, "LA", None), ("2", "K7", "OLD", "STRANGER", "IF", None), ("3", "K8", "CORP", "", "IF", None),
                ("2", "K9", "AGT", None, "IF", None),
            )
        ],
    )
    base.update(more)
    return tables(spark, **base)


def test_new_agents(spark):
    r = intake.new_agents(intake_case(spark), AS_OF)
    assert rows(r.tables["r_user"].where("user_id > 100"), "user_id", "status", "pwd_regen_flag", "email_notify_flag", "created_by") == [
        (101, "R", "Y", "Y", "EOD-NEWFE")
    ]
    assert rows(r.tables["r_user_info"].where("user_id > 100"), "user_info_id", "user_id", "user_type", "clntnum", "status") == [
        (201, 101, "E", "AGT     ", "A")
    ]
    assert "r_user_role" not in r.tables
    assert audit_of(r) == [("NEW_AGENT", "R_USER,R_USER_INFO", None, "101|201|AGT     ")]


def test_new_investors_after_agents(spark):
    t = intake_case(spark)
    t = intake.new_agents(t, AS_OF).over(t)
    r = intake.new_investors(t, AS_OF)
    users = r.tables["r_user"].join(r.tables["r_user_info"].drop("status", "created_by", "dt_created"), "user_id").where("user_id > 101")
    assert {x[1:] for x in rows(users, "user_id", "clntnum", "status", "pwd_regen_flag", "email_notify_flag")} == {
        ("INV1", "R", "Y", "Y"), ("INV2", "I", "N", "N"), ("INV3", "I", "N", "N"), ("CORP", "R", "Y", "N")
    }
    assert [x[0] for x in rows(users, "user_id")] == [102, 103, 104, 105]
    new_roles = r.tables["r_user_role"].where("user_role_id > 300")
    assert rows(new_roles, "role_id", "status") == [(5, "A")] * 4
    assert {x[0] for x in rows(new_roles, "user_id")} == {102, 103, 104, 105}
    assert r.audit.count() == 4 and all(x[1] == "R_USER,R_USER_INFO,R_USER_ROLE" for x in audit_of(r))
    assert intake.new_investors(r.over(t), AS_OF).audit.count() == 0


def test_take_in(spark):
    t = intake_case(
        spark,
        trx_ut=[{"trx_ut_id": 1, "e_reference_number": " R1 ", "account_id": 71, "new_account_flag": "Y"},
                {"trx_ut_id": 2, "e_reference_number": "R2", "account_id": 72, "new_account_flag": "Y"},
                {"trx_ut_id": 3, "e_reference_number": "R3", "account_id": 73, "new_account_flag": "N"}],
        ifsdmutrnpf=[{"ztranref": "R1", "chdrcoy": "2", "chdrnum": "K4", "trdt": 20240610},
                     {"ztranref": "R1  ", "chdrcoy": "2", "chdrnum": "K4", "trdt": 20240611},
                     {"ztranref": "R2", "chdrcoy": "2", "chdrnum": "P1", "trdt": 20240611},
                     {"ztranref": "R3", "chdrcoy": "2", "chdrnum": "P1", "trdt": 20240611}],
        plan_acct=[{"acctid": 900, "chdrcoy": "2", "chdrnum": "P1", "status": "A"}],
        tmp_portfolio=[{"portfolio_id": 1, "account_temp_id": 71, "status": "A"}, {"portfolio_id": 2, "account_temp_id": 72}],
        tmp_portfolio_target=[{"portfolio_id": 1, "aa_class_id": 4, "percentage": money(60)}, {"portfolio_id": 1, "aa_class_id": 5, "percentage": money(40)}],
        tmp_account=[{"account_temp_id": 71, "beneficial_name": "Ben", "branch_name": None}],
    )
    t["ifsdmchdrpf"] = t["ifsdmchdrpf"].unionByName(
        t["ifsdmchdrpf"].limit(1).select(*[F.lit({"chdrcoy": "2", "chdrnum": "P1", "statcode": "IF"}.get(c)).cast(ty).alias(c)
                                          if c in ("chdrcoy", "chdrnum", "statcode", "cownnum", "jownnum") else F.col(c)
                                          for c, ty in t["ifsdmchdrpf"].dtypes]))
    r = plans.take_in(t, AS_OF)
    state = r.over(t)
    infos = dict((c.strip(), i) for c, i in rows(state["r_user_info"], "clntnum", "user_info_id"))
    accounts = {n: (a, e, s) for n, a, e, s in rows(state["plan_acct"].where("acctid > 900"), "chdrnum", "acctid", "entity_id", "status")}
    assert set(accounts) == {"K1", "K2", "K3", "K4", "K8", "K9"}
    assert sorted(a for a, _, _ in accounts.values()) == list(range(901, 907))
    assert accounts["K1"][1] == accounts["K3"][1] != accounts["K2"][1]
    customers = {e: (k, a) for e, k, a in rows(state["r_customer"], "entityid", "customer_type", "auth_type")}
    assert customers[accounts["K1"][1]] == ("JOI", "AND")
    assert customers[accounts["K2"][1]] == ("IND", None) and customers[accounts["K8"][1]] == ("COR", None)
    assert len(customers) == 5
    members = set(rows(state["r_custuser_matrix"], "entity_id", "relationship", "user_info_id"))
    assert {(accounts["K1"][1], "JO1", infos["INV1"]), (accounts["K1"][1], "JO2", infos["INV2"]), (accounts["K4"][1], "JO1", infos["INV3"])} <= members
    assert len(members) == 6
    # portfolio of the new account, and the staged one of the older account
    assert rows(state["portfolio"], "portfolio_id", "acct_id", "created_by") == [(1, accounts["K4"][0], "EOD-NEWFE"), (2, 900, "EOD-NEWFE")]
    assert rows(state["portfolio_target"], "aa_class_id") == [(4,), (5,)]
    assert rows(state["plan_acct"].where("chdrnum = 'K4'"), "beneficial_name", "branch_name", "updated_by") == [("Ben", None, "EOD-NEWFE")]
    # the agent owns a contract too, and had no role
    assert (infos["AGT"] - 100, 5) in rows(state["r_user_role"], "user_id", "role_id")
    audit = audit_of(r)
    joint = [a for a in audit if a[1] == ",R_CUSTOMER,R_CUSTUSER_MATRIX" and "INV2" in a[3]]
    assert joint == [("NEW_ACCT", ",R_CUSTOMER,R_CUSTUSER_MATRIX", None, f"|{accounts['K1'][1]}|INV1|INV2")]
    by_account = {a[3].split("|")[2]: a[1] for a in audit if a[1].startswith("PLAN_ACCT")}
    assert by_account["K1"] == "PLAN_ACCT,R_CUSTOMER,R_CUSTUSER_MATRIX" and by_account["K3"] == "PLAN_ACCT"
    assert r.log_names == ("NEW_AGENT", "NEW_USER", "NEW_ACCT")
    again = plans.take_in(state, AS_OF)
    for name, df in again.tables.items():
        assert rows(df) == rows(state[name]), name


def test_beneficiaries_need_one_account(spark):
    t = tables(
        spark, trx_ut=[{"trx_ut_id": 1, "e_reference_number": "R1", "account_id": 71}],
        ifsdmutrnpf=[{"ztranref": "R1", "chdrcoy": "2", "chdrnum": n} for n in ("K1", "K2")],
        ifsdmchdrpf=[{"chdrcoy": "2", "chdrnum": n} for n in ("K1", "K2")],
        plan_acct=[{"acctid": 1, "chdrcoy": "2", "chdrnum": "K1"}, {"acctid": 2, "chdrcoy": "2", "chdrnum": "K2"},
                   {"acctid": 3, "chdrcoy": "3", "chdrnum": "K1"}],
        tmp_account=[{"account_temp_id": 71, "branch_name": "B"}],
        tmp_portfolio=[{"portfolio_id": 1, "account_temp_id": 71}],
    )
    ref = spark.createDataFrame([("R1",)], "reference string")
    r = portfolios.copy_beneficiaries(t, ref, AS_OF)
    assert rows(r.tables["plan_acct"], "acctid", "branch_name") == [(1, None), (2, None), (3, None)]
    assert rows(r.out["ambiguous_references"]) == [("R1", 2)]
    assert rows(r.tables["eod_log"], "eod_proc_name", "status") == [("updatebeneficialplanacct", "F")]
    assert rows(portfolios.insert_portfolios(t, ref, AS_OF).tables["portfolio"], "acct_id") == [(1,), (2,)]
    loose = portfolios.insert_portfolios(t, ref, AS_OF, match_company=False)
    assert rows(loose.tables["portfolio"], "acct_id") == [(1,), (2,), (3,)]


def test_new_accounts_look_for_the_accounts_of_references_once(spark, monkeypatch):
    """Portfolios and beneficiaries take theirs from one search over the trades."""
    searched, search = [], portfolios.accounts_of

    def counted(*args, **more):
        searched.append(1)
        return search(*args, **more)

    monkeypatch.setattr(portfolios, "accounts_of", counted)
    made = intake_case(spark)
    intake.new_accounts(made, AS_OF)
    assert len(searched) == 1


def test_investor_role_must_be_unique(spark):
    role = lambda i: {"role_id": i, "role_nm": "INVESTOR", "role_type": "I"}
    t = intake_case(spark, r_role=[role(5), role(6)])
    with pytest.raises(Exception, match="(?i)subquery"):
        intake.new_investors(t, AS_OF).tables["r_user_role"].collect()
    t = intake_case(spark, r_role=[])
    roles = intake.new_investors(t, AS_OF).tables["r_user_role"].where("user_role_id > 300")
    assert {r for (r,) in rows(roles, "role_id")} == {None}


def test_appended_rows_combine_over_steps(spark):
    t = intake_case(spark)
    r = plans.chain(t, AS_OF, intake.new_agents, intake.new_investors)
    for name in ("r_user", "r_user_info"):
        assert rows(t[name].unionByName(r.appended[name])) == rows(r.tables[name])
    assert r.appended["r_user"].count() == 1 + 4  # one agent, four investors


def test_get_entities_treats_blank_and_null_alike(spark):
    t = tables(
        spark, r_custuser_matrix=[{"entity_id": 1, "relationship": "JO1", "user_info_id": 1}],
        r_user_info=[{"user_info_id": 1, "clntnum": "A       "}],
    )
    pairs = spark.createDataFrame([("A", None), ("A", "        "), ("B", None)], "main string, joint string")
    assert rows(get_entities(t, pairs), "main", "entity_id") == [("A", 1), ("B", -999)]


# --- running and logging ---------------------------------------------------------

def test_run_job_writes_or_logs_failure(spark, tmp_path):
    t = approval_case(spark)
    state = plans.run_job(spark, plans.expire_approvals, "DelExpTrnReqWOApp", t, AS_OF, str(tmp_path / "ok"))
    assert rows(state["eod_log"], "eod_proc_name", "eod_date", "status", "created_by") == [("DelExpTrnReqWOApp", AS_OF, "S", "EOD_PROCESS")]
    assert state["audit_trail"].count() == 3 and state["pending_approval"].count() == 6
    ids = [i for (i,) in rows(state["audit_trail"], "audit_id")]
    assert len(set(ids)) == 3
    t["r_sysparam"] = t["r_sysparam"].limit(0)
    failed = plans.run_job(spark, plans.expire_approvals, "DelExpTrnReqWOApp", t, AS_OF, str(tmp_path / "bad"))
    assert rows(failed["eod_log"], "eod_proc_name", "status") == [("DelExpTrnReqWOApp", "F")]
    assert "PENDINGAPPROVAL_DAYS" in failed["eod_log"].first()["remarks"]
    assert failed["pending_approval"] is t["pending_approval"]


def test_jobs_and_failures_share_a_folder(spark, tmp_path):
    t, state = approval_case(spark), approval_case(spark)
    for _ in range(2):
        state = plans.run_job(spark, plans.expire_approvals, "DelExpTrnReqWOApp", state, AS_OF, str(tmp_path))
    broken = {**state, "r_sysparam": t["r_sysparam"].limit(0)}
    for _ in range(2):
        broken = plans.run_job(spark, plans.expire_approvals, "DelExpTrnReqWOApp", broken, AS_OF, str(tmp_path))
    assert [s for (s,) in rows(broken["eod_log"], "status")] == ["F", "F", "S", "S"]
    assert broken["audit_trail"].count() == 3


def test_archive_refuses_to_lose_a_column(spark):
    t = tables(spark, r_sysparam=params(TRX_HISTORY_DURATION_MONTH=90), trx_ut=[{"trx_ut_id": 1, "dt_created": ago(90)}])
    t["trx_ut"] = t["trx_ut"].withColumn("new_column", F.lit("x"))
    with pytest.raises(ValueError, match="new_column"):
        plans.archive_transactions(t, AS_OF)


def test_marks_move_with_the_log(spark):
    t = intake_case(spark)
    r = intake.new_agents(t, AS_OF)
    state = plans.next_state(spark, t, r, AS_OF)
    assert intake.high_water_mark(state["eod_log"], "NEW_AGENT") == datetime(2024, 6, 10, 12)
    assert state["audit_trail"].count() == 1
