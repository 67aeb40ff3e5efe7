"""The thirteen feeds. Keys, policies and update lists are fixed values."""

from __future__ import annotations

from millrace.functions.routing import ROUTES
from millrace.plans import schemas as S
from millrace.plans.spec import FeedSpec, brokerage_words

# Key columns of the brokerage feed and the rest of the columns known by name.
BROKERAGE_KINDS = {
    "prcode": "string",
    "accountno": "string",
    "trno": "string",
    "fromdate": "date",
    "todate": "date",
    "amount": "double",
    "units": "double",
    "percentage": "double",
    "brokerage": "double",
}

FEEDS = {
    spec.code: spec
    for spec in (
        FeedSpec(
            "wbr2c",
            ROUTES["wbr2c"],
            S.WBR2C,
            keys=("folio_no", "trxnno", "traddate"),
            in_file="first",
            update=("amount", "units", "purprice", "postdate", "remarks", "updated_at"),
            part_date="traddate",
        ),
        FeedSpec(
            "wbr9",
            ROUTES["wbr9"],
            S.WBR9,
            keys=("foliochk", "product", "sch_name", "rep_date"),
            in_file="first",
            update=(
                "inv_name", "address1", "address2", "address3", "city", "pincode", "clos_bal",
                "rupee_bal", "jnt_name1", "jnt_name2", "phone_off", "phone_res", "email", "mobile_no",
                "uin_no", "pan_no", "bank_name", "branch", "ac_type", "ac_no", "ifsc_code", "aadhaar",
                "updated_at", "file_path",
            ),
            part_date="rep_date",
        ),
        FeedSpec(
            "wbr9c",
            ROUTES["wbr9c"],
            S.WBR9C,
            keys=("foliochk", "amc_code", "product_co"),
            in_file="first",
            update=(
                "inv_name", "address1", "address2", "address3", "city", "pincode", "pan_pekrn",
                "updated_at",
            ),
        ),
        FeedSpec(
            "wbr49",
            ROUTES["wbr49"],
            S.WBR49,
            keys=("folio_no", "auto_trno", "from_date"),
            in_file="first",
            part_date="from_date",
        ),
        FeedSpec(
            "wbr5",
            ROUTES["wbr5"],
            S.WBR5,
            keys=("folio_no", "ref_no", "to_date"),
            in_file="first",
            policy="declared_key",
            part_date="to_date",
        ),
        FeedSpec(
            "wbcum",
            ROUTES["wbcum"],
            S.WBCUM,
            keys=("acno", "scheme", "todate"),
            in_file="first",
            update=("balunits", "valinv", "lnav", "trdate", "updated_at"),
            part_date="todate",
        ),
        FeedSpec(
            "scheme",
            "mutual_funds",
            S.SCHEME,
            keys=("scheme_code", "plan_name", "plan_type"),
            in_file="last",
            complete_key=True,
            workbook=True,
        ),
        FeedSpec(
            "wbr22",
            ROUTES["wbr22"],
            S.WBR22,
            keys=("brok_dlr_c", "folio", "scheme_nam", "asset_date"),
            policy="contact_only",
            update=("inv_name", "mobile", "updated_at"),
            part_date="asset_date",
        ),
        FeedSpec(
            "wbtrn",
            ROUTES["wbtrn"],
            S.WBTRN,
            keys=("unqno",),
            policy="if_changed",
            tracked=("td_trno", "td_trdt", "td_amt"),
        ),
        FeedSpec(
            "wbr2",
            ROUTES["wbr2"],
            S.WBR2,
            keys=("amc_code", "folio_no", "trxnno", "traddate"),
            policy="last_wins",
            dynamic=True,
            part_date="traddate",
        ),
        FeedSpec(
            "wbbrok",
            ROUTES["wbbrok"],
            BROKERAGE_KINDS,
            keys=("prcode", "accountno", "trno", "fromdate"),
            policy="dynamic_key",
            dynamic=True,
            part_date="fromdate",
            **brokerage_words(),
        ),
        FeedSpec("wbr77", ROUTES["wbr77"], S.WBR77, policy="append"),
        FeedSpec("wbmst", ROUTES["wbmst"], S.WBMST, policy="append"),
    )
}
