import itertools

import pytest

from duskwork import plans
from duskwork.plans import refresh
from duskwork.plans.descriptions import describe, items, note_keys, type_combinations
from tests.helpers import AS_OF, ago, rows, tables

TODAY = 20240615


# --- explanatory notes -----------------------------------------------------------

def note_case(spark, **more):
    item = lambda coy, it, long, tran, pfx="IT": {
        "itempfx": pfx, "itemcoy": coy, "itemitem": it, "longdesc": long, "trandesc": tran}
    base = dict(
        ifsdmcovrpf=[{"crtable": c, "chdrcoy": y, "coverage": v, "rider": r, "validflag": f} for c, y, v, r, f in (
            ("CV1", "2", "01", "00", "1"), ("CV1", "3", "01", "00", "1"), ("CV9", "2", "02", "00", "1"), ("CV8", "2", "01", "00", "2"))],
        ifsdmcovtpf=[{"crtable": "CV2", "chdrcoy": "7", "coverage": "01", "rider": "00"},
                     {"crtable": "CV7", "chdrcoy": "9", "coverage": "01", "rider": "00"}],
        ifsdmt3590=[{"itemitem": "M  "}, {"itemitem": "M"}, {"itemitem": "Q_"}],
        ifsdmt5687=[{"itemcoy": "1", "itemitem": "CV1     ", "itmto": "99999999", "sp_ind": "S"},
                    {"itemcoy": "2", "itemitem": "CV1     ", "itmto": "99999999", "sp_ind": "S"},
                    {"itemcoy": "2", "itemitem": "CV1     ", "itmto": "99999999", "sp_ind": "T"},
                    {"itemcoy": "3", "itemitem": "CV1     ", "itmto": "20200101", "sp_ind": "S"}],
        ifsdmt9065=[item("2", "EXMS1   ", " noteA ", " textA "), item("9", "EXMS2", "x", "x"), item("2", "EXMS3", "x", "x", "XX"),
                    item("1", "EX**-1  ", "noteB", "textB"), item("1", "EXQZ-7  ", "noteC", "textC"), item("1", "EX**S   ", "noteD", None)],
        r_explanatory_notes=[{"chdrcoy": "1", "billfreq": "M", "crtable": "CV1", "noteitem": "noteA", "notedesc": "old"},
                             {"chdrcoy": "1", "billfreq": "Z", "crtable": "CV1", "noteitem": "noteA", "notedesc": "stays"}],
    )
    base.update(more)
    return tables(spark, **base)


def test_note_keys(spark):
    got = rows(note_keys(note_case(spark)), "crtable", "billfreq", "chdrcoy")
    assert got == sorted(itertools.product(("CV1", "CV2"), ("M", "Q_"), "123"))


def test_refresh_notes(spark):
    t = note_case(spark)
    r = plans.refresh_notes(t, AS_OF)
    got = {(c, f, k, i): d for c, f, k, i, d in rows(r.tables["r_explanatory_notes"], "crtable", "billfreq", "chdrcoy", "noteitem", "notedesc")}
    expected = {("CV1", "M", "1", "noteA"): "textA", ("CV1", "Z", "1", "noteA"): "stays"}
    expected[("CV1", "Q_", "1", "noteD")] = None  # indicator S, no such item, any frequency
    for key in itertools.product(("CV1", "CV2"), "M", "123"):
        if key != ("CV1", "M", "1"):
            expected[(*key, "noteB")] = "textB"  # no single indicator: '-', any frequency
    for key in itertools.product(("CV1", "CV2"), ("Q_",), "123"):
        if key != ("CV1", "Q_", "1"):
            expected[(*key, "noteC")] = "textC"  # the underscore is a wildcard
    assert got == expected
    again = plans.refresh_notes(r.over(t), AS_OF)
    assert rows(again.tables["r_explanatory_notes"]) == rows(r.tables["r_explanatory_notes"])


def test_notes_held_by_two_companies_take_the_smallest_and_merge_once(spark):
    t = note_case(spark)
    once = plans.refresh_notes(t, AS_OF)
    extra = t["ifsdmt9065"].where("itemitem = 'EXMS1   '").selectExpr("itempfx", "'3' AS itemcoy", "itemitem", "longdesc", "trandesc")
    t["ifsdmt9065"] = t["ifsdmt9065"].union(extra)
    state = t
    for _ in range(3):
        r = plans.refresh_notes(state, AS_OF)
        assert rows(r.tables["r_explanatory_notes"]) == rows(once.tables["r_explanatory_notes"])
        state = r.over(state)


def test_notes_without_text_are_merged_once(spark):
    t = note_case(spark)
    t["ifsdmt9065"] = t["ifsdmt9065"].selectExpr("itempfx", "itemcoy", "itemitem", "' ' AS longdesc", "trandesc")
    first = plans.refresh_notes(t, AS_OF)
    again = plans.refresh_notes(first.over(t), AS_OF)
    assert rows(again.tables["r_explanatory_notes"]) == rows(first.tables["r_explanatory_notes"])


# --- transaction descriptions ------------------------------------------------------

def test_type_combinations(spark):
    t = tables(
        spark, ifsdmchdrpf=[{"chdrcoy": "2", "chdrnum": "K1", "cnttype": "C1"}, {"chdrcoy": "3", "chdrnum": "K1", "cnttype": "C2"}],
        ifsdmlzubpf=[{"chdrcoy": "2", "chdrnum": "K1", "vrtfnd": "F1", "unityp": "U1"}, {"chdrcoy": "2", "chdrnum": "K1", "vrtfnd": "F2", "unityp": "U2"}],
        ifsdmutrnpf=[{"chdrcoy": "2", "chdrnum": "K1", "vrtfnd": "F1", "batctrcde": "B1", "sacstyp": "S1"}] * 3
        + [{"chdrcoy": "2", "chdrnum": "K1", "vrtfnd": "F9", "batctrcde": "B9", "sacstyp": "S9"}],
        ifsdmlzsdpf=[{"chdrcoy": "3", "chdrnum": "K1", "unityp": "U3", "batctrcde": "B3", "sacstyp": "S3"},
                     {"chdrcoy": "2", "chdrnum": "K1", "unityp": "U1", "batctrcde": "B1", "sacstyp": "S1"}],
    )
    assert rows(type_combinations(t)) == [("C1", "U1", "B1", "S1"), ("C2", "U3", "B3", "S3")]


def test_refresh_descriptions_uses_each_step(spark):
    item = lambda it, tran, coy="2": {"itempfx": "IT", "itemcoy": coy, "itemitem": it, "trandesc": tran, "longdesc": "L"}
    segment = "." * 78 + "TARGET01 T1S1 here".ljust(78)
    t = tables(
        spark,
        ifsdmchdrpf=[{"chdrcoy": "2", "chdrnum": f"K{i}", "cnttype": "CA"} for i in range(1, 8)],
        ifsdmlzsdpf=[{"chdrcoy": "2", "chdrnum": f"K{i}", "unityp": u, "batctrcde": b, "sacstyp": s} for i, (u, b, s) in enumerate((
            ("U", "T1", "S1"), ("U", "T2", "S2"), ("U", "T3", "S3"), ("U", "T4", "S4"), ("U", "T5", "S5"), ("U", "T6", "S6"), (None, "T6", "S6")), 1)],
        ifsdmt9065=[item("T1CAU", segment), item("TARGET01", " by segment "), item("T1S1U", "not reached"),
                    item("xT2S2Ux", "two-b", "3"), item("yT2S2Uy", "two-a"), item("****S3U", "three"), item("****S4", "four"),
                    {"itempfx": "XX", "itemcoy": "2", "itemitem": "T6S6U", "trandesc": "no"}],
        ifsdmt1688=[{"itempfx": "IT", "itemcoy": "2", "itemitem": "T5", "longdesc": " five "}],
        r_trx_description=[{"cnttype": "CA", "unityp": "U", "batctrcde": "T6", "sacstyp": "S6", "trandesc": "old"},
                           {"cnttype": "CA", "unityp": "U", "batctrcde": "T0", "sacstyp": "S0", "trandesc": "stays"}],
    )
    r = plans.refresh_descriptions(t, AS_OF)
    got = rows(r.tables["r_trx_description"], "batctrcde", "unityp", "trandesc")
    assert got == sorted([
        ("T0", "U", "stays"), ("T1", "U", "by segment"), ("T2", "U", "two-a"), ("T3", "U", "three"), ("T4", "U", "four"),
        ("T5", "U", "five"), ("T6", "U", None), ("T6", None, None),
    ], key=lambda row: tuple((v is None, str(v)) for v in row))


def test_segment_step_tries_the_next_segment(spark):
    keys = spark.createDataFrame([("C", "U", "B", "S")], "cnttype string, unityp string, batctrcde string, sacstyp string")
    text = "NOWHERE0 BS".ljust(78) + "TARGET02 BS".ljust(78)
    lookup = spark.createDataFrame(
        [("IT", "1", "BCU", "l", text), ("IT", "1", "TARGET02", "l", "found"), ("IT", "9", "NOWHERE0", "l", "other company")],
        "itempfx string, itemcoy string, itemitem string, longdesc string, trandesc string")
    assert rows(describe(keys, items(lookup), items(lookup)), "trandesc") == [("found",)]


# --- plan accounts -----------------------------------------------------------------

def account_case(spark):
    contract = lambda coy, n, s, d: {"chdrcoy": coy, "chdrnum": n, "statcode": s, "modidate": d}
    return tables(
        spark, eod_log=[{"eod_proc_name": "REFRESH PLANACCT", "eod_date": ago(5), "status": "S"}],
        ifsdmchdrpf=[contract("2", "K1", "LA", 20240606), contract("2", "K2", "LA", 20240605), contract("3", "K3", "IF", 1), contract("1", "K4", "IF", 1),
                     contract("2", "K5", None, 20240615), contract("2", "K6", "LA", 20240615), contract("2", "K6", "AC", 20240615)],
        plan_acct=[{"acctid": i, "chdrcoy": c, "chdrnum": n, "status": s} for i, c, n, s in (
            (1, "2", "K1", "A"), (2, "2", "K2", "A"), (3, "3", "K3", "I"), (4, "1", "K4", "I"), (5, "2", "K5", "A"), (6, "2", "K6", "A"),
            (7, "3", "K1", "A"), (8, "2", "K3", "X"), (9, None, None, "A"))],
    )


def test_refresh_accounts(spark):
    r = plans.refresh_accounts(account_case(spark), AS_OF)
    got = {i: (s, b) for i, s, b in rows(r.tables["plan_acct"], "acctid", "status", "updated_by")}
    a, b = "REFRESH PLANACCT A", "REFRESH PLANACCT B"
    assert got == {1: ("I", a), 2: ("A", None), 3: ("A", b), 4: ("I", None), 5: ("A", None), 6: ("A", b), 7: ("A", None), 8: ("X", None), 9: ("A", None)}


def test_refresh_accounts_by_number_alone(spark):
    r = plans.refresh_accounts(account_case(spark), AS_OF, match_company=False)
    got = {i: s for i, s in rows(r.tables["plan_acct"], "acctid", "status")}
    assert got == {1: "I", 2: "A", 3: "A", 4: "I", 5: "A", 6: "A", 7: "I", 8: "A", 9: "A"}


# --- users -------------------------------------------------------------------------

class People:
    """Collects the rows of one user story after the other."""

    def __init__(self):
        self.t = {n: [] for n in ("r_user", "r_user_info", "ifsdmclntpf", "ifsdmaglfpf", "ifsdmchdrpf", "v_userrole", "r_user_role")}

    def add(self, i, status="A", web="Y", kind="E", agents=(), roles=(), user_roles=(), owns=(), serves=()):
        self.t["r_user"].append({"user_id": i, "status": status, "pwd_regen_flag": "N"})
        self.t["r_user_info"].append({"user_info_id": i, "user_id": i, "user_type": kind, "clntnum": f"C{i}"})
        self.t["ifsdmclntpf"].append({"clntnum": f"C{i}      ", "cltmchg": web})
        for n, (coy, cls, until) in enumerate(agents):
            self.t["ifsdmaglfpf"].append({"clntnum": f"C{i}", "agntnum": f"A{i}-{n}", "agntcoy": coy, "zlfagtcl": cls, "dtetrm": until})
        self.t["v_userrole"] += [{"user_id": i, "role_id": r} for r in roles]
        self.t["r_user_role"] += [{"user_id": i, "role_id": r} for r in user_roles]
        for coy, stat, who in owns:
            self.t["ifsdmchdrpf"].append({"chdrcoy": coy, "chdrnum": f"O{i}", "statcode": stat, "cownnum": "X", "jownnum": None, who: f"C{i}  "})
        for n, coy, stat in serves:
            self.t["ifsdmchdrpf"].append({"chdrcoy": coy, "chdrnum": f"S{i}", "statcode": stat, "servagnt": f"A{i}-{n}"})

    def tables(self, spark):
        return tables(
            spark, r_role=[{"role_id": 1, "role_type": "V"}, {"role_id": 2, "role_type": "I"}, {"role_id": 3, "role_type": "M"}, {"role_id": 4, "role_type": "V"}],
            r_agt_cl_role_map=[{"zlfagtcl": "ADV", "role_id": 1}, {"zlfagtcl": "MGR", "role_id": 3}, {"zlfagtcl": "INV", "role_id": 2}], **self.t)


LIVE, ENDED, OPEN = TODAY + 1, TODAY - 1, 99999999


def test_refresh_users(spark):
    p, want = People(), {}
    u = "REFRESH USR "

    def case(i, expect, **story):
        p.add(i, **story)
        want[i] = expect

    # 2A: not web-enabled
    case(1, ("I", "N", u + "2A"), web="N")
    case(2, ("I", "N", None), web="N", status="I")
    case(3, (None, "N", None), web="N", status=None)
    # 2B: other roles
    case(10, ("I", "Y", u + "2B"), status="I", agents=[("2", "MGR", LIVE)])
    case(11, ("A", "N", None), agents=[("2", "MGR", LIVE)])
    case(12, ("I", "N", u + "2B-ii"), agents=[("2", "MGR", TODAY)])
    case(13, ("A", "N", None), agents=[("2", "MGR", ENDED)], owns=[("2", "IF", "cownnum")])
    case(14, ("I", "N", u + "2B-ii"), agents=[("2", "MGR", ENDED)], owns=[("1", "IF", "cownnum")])
    case(15, ("A", "N", None), agents=[("2", "MGR", ENDED), ("3", "ADV", OPEN)], user_roles=[1], roles=[3])
    case(16, ("I", "N", u + "2B-ii"), agents=[("2", "MGR", ENDED), ("1", "ADV", OPEN)], user_roles=[1], roles=[3])
    case(17, ("A", "N", None), agents=[("2", "MGR", ENDED)], kind="I")
    # 2C: adviser and investor
    case(20, ("I", "Y", u + "2C"), status="I", roles=[1, 2], owns=[("2", "AC", "jownnum")])
    case(21, ("I", "Y", u + "2C"), status="I", roles=[1, 2], agents=[("2", "X", LIVE)], serves=[(0, "3", "IF")])
    case(22, ("I", "N", u + "2C"), roles=[1, 2], agents=[("2", "X", TODAY)], serves=[(0, "3", "IF")])
    case(23, ("I", "N", u + "2C"), roles=[1, 2], status="R")
    case(24, ("A", "N", None), roles=[1, 4])
    case(25, ("A", "N", None), roles=[1, 2, 3])
    case(26, ("A", "N", None), roles=[1, 2], kind="I")
    case(27, (None, "N", None), roles=[1, 2], status=None)
    # 2D: adviser only
    case(30, ("A", "N", None), agents=[("2", "ADV", TODAY)], serves=[(0, "2", "IF")])
    case(31, ("I", "Y", u + "2D"), status="I", agents=[("2", "ADV", OPEN)], serves=[(0, "2", "AC")])
    case(32, ("I", "N", u + "2D"), agents=[("2", "ADV", OPEN)], serves=[(0, "3", "IF")])
    case(33, ("A", "N", None), agents=[("2", "ADV", OPEN), ("3", "ADV", OPEN)], serves=[(1, "3", "IF")])
    case(34, ("A", "N", None), agents=[("2", "ADV", ENDED)])
    case(35, ("A", "N", None), agents=[("2", "ADV", OPEN), ("2", "MGR", OPEN)])
    case(36, ("A", "N", None), agents=[("2", "ADV", OPEN)], user_roles=[1], roles=[1])
    # 2E: investor only
    case(40, ("A", "N", None), user_roles=[2], roles=[2], owns=[("3", "IF", "cownnum")])
    case(41, ("I", "Y", u + "2E"), status="I", user_roles=[2], roles=[2], owns=[("3", "IF", "jownnum")])
    case(42, ("I", "N", u + "2E"), user_roles=[2], roles=[2], owns=[("3", "LA", "cownnum")])
    case(43, ("A", "N", None), user_roles=[2], roles=[2, 3])
    case(44, ("A", "N", None))
    r = plans.refresh_users(p.tables(spark), AS_OF)
    got = {i: (s, f, b) for i, s, f, b in rows(r.tables["r_user"], "user_id", "status", "pwd_regen_flag", "updated_by")}
    assert got == want
    reset = {i for (i,) in rows(r.tables["r_user"].where("dt_reset_password_updated IS NOT NULL"), "user_id")}
    assert reset == {i for i, (_, f, _) in want.items() if f == "Y"}
    assert r.log_names == (refresh.USERS_LOG_NAME,)
