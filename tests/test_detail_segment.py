"""Loan detail on hand-built personal-loan tables."""

import datetime as dt
from decimal import Decimal as d

from lendgrid.rundate import RunDate
from lendgrid.segments import Catalog
from lendgrid.segments.detail import DETAIL_COLUMNS, loan_detail

RUN = RunDate(dt.date(2024, 1, 31))
B, O, P = dt.date(2024, 1, 1), dt.date(9999, 12, 31), "202401"
H = "begndt date, overdt date, partid string"

LOAN_COLS = [
    ("lnpa_istu_insttu_cde", "string"), ("lnpa_loan_typ", "string"), ("loan_no", "string"), ("debt_sts", "string"),
    ("sts", "string"), ("term_combine_ind", "string"), ("balloon_ind", "string"), ("loan_grd", "string"),
    ("actv_dt", "string"), ("ctif_id_type", "string"), ("ctif_id_no", "string"), ("ctif_iss_ctry", "string"),
    ("orig_prcp", "decimal(20,2)"), ("prps_fin", "string"), ("os_prcp", "decimal(20,2)"), ("loan_tnr", "int"),
    ("bhdt_bch_cde", "string"), ("loan_target", "string"), ("aofr_acct_offcr_cde", "string"), ("last_due_dt", "string"),
    ("base_rate", "decimal(12,6)"), ("int_adj_pct", "decimal(12,6)"), ("sprd", "decimal(12,6)"),
    ("main_gur_typ", "string"), ("prod_cde", "string"), ("recourse", "string"), ("cust_ref", "string"),
    ("refinc_furchrg_ind", "string"),
]
CUST_COLS = ["id_type", "id_no", "iss_ctry", "br_no", "idsy_pfsn", "cust_nam"] + [
    f"addr{n}_{f}" for n in range(1, 6) for f in (["type", "province_cde", "lct_cde", "dist_cde"] if n <= 3 else ["type"])
] + [f"addr{n}_l{i}" for n in range(1, 6) for i in range(1, 5)]


def hist(spark, rows, schema):
    return spark.createDataFrame([(*r, B, O, P) for r in rows], schema + ", " + H)


def loan(**kw):
    base = dict(lnpa_istu_insttu_cde="I1", debt_sts="NORM", sts="ACTV", term_combine_ind="N", balloon_ind="N",
                loan_grd="100", actv_dt="20230101", ctif_id_type="T", ctif_id_no="ID1", ctif_iss_ctry="CN",
                orig_prcp=d("1000"), prps_fin=None, os_prcp=d("800"), loan_tnr=12, bhdt_bch_cde="0201",
                loan_target="TGT", aofr_acct_offcr_cde="OF1", last_due_dt="20250101", base_rate=d("3.1"),
                int_adj_pct=d("0"), sprd=d("0.5"), main_gur_typ="COLL", prod_cde="P1", recourse="Y", cust_ref="G1",
                refinc_furchrg_ind=None)
    base.update(kw)
    return tuple(base[c] for c, _ in LOAN_COLS)


def cust(**kw):
    base = {c: None for c in CUST_COLS}
    base.update(kw)
    return tuple(base[c] for c in CUST_COLS)


def build_frames(spark):
    loans = [
        loan(lnpa_loan_typ="1401", loan_no="N1", refinc_furchrg_ind="E"),
        loan(lnpa_loan_typ="1201", loan_no="N2", orig_prcp=d("500"), prps_fin="PX"),
        loan(lnpa_loan_typ="1001", loan_no="N3", sts="SETL", actv_dt="20240110", ctif_id_no="ID2", loan_grd="300",
             bhdt_bch_cde="010123", refinc_furchrg_ind="Q"),
        loan(lnpa_loan_typ="1401", loan_no="N4", debt_sts="CHRGO"),
        loan(lnpa_loan_typ="1101", loan_no="N5"),
    ]
    bal_s = ("insttu_cde string, loan_typ string, loan_no string, loan_grd string, os_days int, os_prcp decimal(20,2), "
             "recv_int decimal(20,2), susp_int decimal(20,2), bal_date string")
    frames = {
        "OMI.PL_LOAN_HS": hist(spark, loans, ", ".join(f"{c} {t}" for c, t in LOAN_COLS)),
        "OMI.PL_LOAN_MONTH_BAL_HS": hist(spark, [
            ("I1", "1401", "N1", "200", 5, d("700"), d("1"), d("2"), "20240131"),
            ("I1", "1201", "N2", "100", 0, d("300"), d("0"), d("0"), "2024-01-31"),
            ("I1", "1101", "N5", "100", 0, d("1"), d("0"), d("0"), "20231231")], bal_s),
        "OMI.PL_LOAN_SCHD_TERM_HS": hist(spark, [
            ("I1", "1401", "N1", 1, d("0"), "T", "X"), ("I1", "1401", "N1", 2, d("5"), "T", "IO"),
            ("I1", "1201", "N2", 1, d("0"), "P", "X"), ("I1", "1201", "N2", 3, d("0"), "P", "X")],
            "lnpa_istu_insttu_cde string, lnpa_loan_typ string, loan_no string, term_no int, "
            "pgs_prcp_amt decimal(20,2), repaym_typ string, repaym_opt string"),
        "OMI.PL_LOAN_PARA_HS": hist(spark, [("1401", "N", "Y", "N", "N"), ("1201", "N", "Y", "N", "N"),
                                            ("1001", "Y", "N", "N", "N")],
                                    "loan_typ string, irreg_ind string, instm_ln_ind string, pf_ind string, "
                                    "trust_ln_ind string"),
        "OMI.PL_PMSH_HDR_HS": hist(spark, [("I1", "1401", "N1", 1, 1), ("I1", "1201", "N2", 1, 1)],
                                   "loan_lnpa_istu_insttu_cde string, loan_lnpa_loan_typ string, loan_loan_no string, "
                                   "prcp_paym_freq int, int_paym_freq int"),
        "OMI.PL_PRPS_FIN_HS": hist(spark, [("18", "Y"), ("PX", "N")], "prps_cde string, is_operate string"),
        "OMI.PL_PROVINCE_CDE_HS": hist(spark, [("P01", "Hubei")], "province_cde string, province_desc string"),
        "OMI.PL_CITY_HS": hist(spark, [("C01", "Wuhan")], "city_cde string, city_desc string"),
        "OMI.PL_DISTRICT_HS": hist(spark, [("D01", "Hongshan")], "dist_cde string, dist_nam string"),
        "OMI.PL_CUST_INFO_HS": hist(spark, [
            cust(id_type="T", id_no="ID1", iss_ctry="CN", br_no="BR", idsy_pfsn="IP", cust_nam="Alice",
                 addr1_type="W", addr2_type="H", addr2_province_cde="P01", addr2_lct_cde="C01", addr2_dist_cde="D01",
                 addr2_l1="Road 1", addr2_l3="#3"),
            cust(id_type="T", id_no="ID2", iss_ctry="CN", cust_nam="Bob", addr5_type="H", addr5_l1="Lane 5")],
            ", ".join(f"{c} string" for c in CUST_COLS)),
        "OMI.PL_INDIV_INFO_HS": hist(spark, [("T", "ID1", "CN", "6", "Y", "E1", "EA1", None),
                                             ("T", "ID2", "CN", "4", None, "E2", "EA2", "NY")],
                                     "ctif_id_type string, ctif_id_no string, ctif_iss_ctry string, fin_insttu string, "
                                     "fin_insttu_2 string, empr string, emp_contact_add string, place_orign string"),
        "OMI.PL_RPT_LN_OS_DTL_HS": hist(spark, [("1401", "N1", "20240131", 3, d("50"), 2, d("10"), d("5"), d("4"), 1)],
                                        "lnpa_loan_typ string, loan_no string, rpt_dt string, od_day_count int, "
                                        "od_prcp decimal(20,2), od_int_day_count int, od_bn_int decimal(20,2), "
                                        "od_bw_int decimal(20,2), od_int decimal(20,2), od_od_int_day_count int"),
        "OMI.PL_COLT_IDX_HS": hist(spark, [("N3", "CI3")], "loan_loan_no string, clcm_colt_itm string"),
        "OMI.PL_COLT_COM_HS": hist(spark, [("CI3", "PTY")], "colt_itm string, clty_colt_typ string"),
        "OMI.COL_CLR_INFO_HS": hist(spark, [("CI3", "02", "03010204")], "clrid string, sourcesystem string, clrtypeid string"),
        "OMI.COL_CLR_ASSET_REALTY_HS": hist(spark, [("CI3", "SP")], "clrid string, lsrealtytype string"),
    }
    return frames


def test_loan_detail_rows(spark):
    df = loan_detail(Catalog.frames(build_frames(spark)), RUN)
    assert df.columns == DETAIL_COLUMNS and len(DETAIL_COLUMNS) == 50
    rows = {r.loan_no: r for r in df.collect()}
    assert set(rows) == {"N1", "N2", "N3"}
    n1, n2, n3 = rows["N1"], rows["N2"], rows["N3"]
    assert (n1.pay_typ, n2.pay_typ, n3.pay_typ) == ("等额递增还款", "等额本金", None)
    assert (n1.loan_grp, n1.loan_grp2, n2.loan_grp, n2.loan_grp2, n3.loan_grp, n3.loan_grp2) == (
        "经营", "经营", "消费", "消费", "消费", "经营")
    assert n1.home_addr == "HubeiWuhanHongshanRoad 1#3" and n3.home_addr == "Lane 5"
    assert (n1.minbuss, n3.minbuss, n1.place_orign, n3.place_orign) == ("个体工商户", "否", "LOCAL", "NY")
    assert (n1.loan_grd, n1.os_days, n1.os_prcp, n1.recv_int) == ("200", 5, d("700"), d("1"))
    assert (n3.loan_grd, n3.os_days, n3.os_prcp) == ("300", 0, 0)
    assert (n1.od_prcp_day, n1.od_prcp_amt, n1.od_int_amt, n1.od_od_int_amt, n2.od_prcp_amt) == (3, d("50"), d("11"), d("4"), 0)
    # customer totals do not exclude charged-off loans (N4 counts)
    assert (n1.sum_orig_prcp, n1.sum_orig_opr, n1.sum_orig_con) == (d("2500"), d("2000"), d("500"))
    assert (n3.sum_orig_prcp, n1.loan_ind, n2.loan_ind, n3.loan_ind) == (0, "续贷", "正常", "其它")
    assert n1.rpt_dt == RUN.d and n1.inc_hos == " " and n1.id_no == "ID1" and n1.cust_nam == "Alice"


def test_collateral_is_looked_up_for_its_loan_type_only(spark):
    """Two collaterals fail the lookup on a loan of the type that it decides, and on no other."""
    import pytest

    def run_with(loan_no):
        own = build_frames(spark)
        own["OMI.PL_COLT_IDX_HS"] = own["OMI.PL_COLT_IDX_HS"].unionByName(
            hist(spark, [(loan_no, "CI3"), (loan_no, "CI3")], "loan_loan_no string, clcm_colt_itm string"))
        return {r.loan_no: r.loan_grp2 for r in loan_detail(Catalog.frames(own), RUN).select("loan_no", "loan_grp", "loan_grp2").collect()}

    assert run_with("N1") == {"N1": "经营", "N2": "消费", "N3": "经营"}
    with pytest.raises(Exception, match="realty collateral"):
        run_with("N3")
