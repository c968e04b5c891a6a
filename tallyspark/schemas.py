"""Declared layouts of every table the jobs read or write.

Column names are lower case: the source system folds unquoted identifiers to
lower case, so ``memberId`` in its DDL is ``memberid`` in every query.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The point-of-sale file layout.  The file carries 42 columns in
# exactly this order (the CSV reader maps them by position).
# ---------------------------------------------------------------------------
POS_HEADER_COLUMNS = [
    "hd_file_extract_date_time", "hd_order_or_tran_id", "hd_order_date_time", "hd_loyalty_id",
    "hd_ean", "hd_shopprimaryid", "hd_channel_type", "hd_brand",
    "hd_store_id", "hd_register_id", "hd_tendered_amt", "hd_shipping_cost",
    "hd_order_total_disc_amt", "hd_tax_amt", "hd_currency", "hd_tendered_giftcard_amt",
    "itm_sku", "itm_quantity", "itm_amt", "itm_amt_after_disc",
]
DISCOUNT_SLOTS = 10
DISCOUNT_COLUMNS = [c for i in range(1, DISCOUNT_SLOTS + 1)
                    for c in (f"discount_code{i}", f"discount_value{i}")]
POS_COLUMNS = POS_HEADER_COLUMNS + DISCOUNT_COLUMNS + ["country", "hd_orig_tran_id"]
assert len(POS_COLUMNS) == 42

# every POS field arrives as text; timestamps are parsed later
POS_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in POS_COLUMNS])

DISCOUNT_CODE_COLUMNS = [f"discount_code{i}" for i in range(1, DISCOUNT_SLOTS + 1)]

# the 21-column layout of a missed line (positional in the source job)
MISSED_SCHEMA = T.StructType(
    [T.StructField("extract_ts", T.TimestampNTZType()),
     T.StructField("tran_id", T.StringType()),
     T.StructField("tran_ts", T.TimestampNTZType()),
     T.StructField("loyalty_id", T.StringType()),
     T.StructField("country", T.StringType()),
     T.StructField("store_id", T.StringType()),
     T.StructField("currency", T.StringType()),
     T.StructField("itm_sku", T.StringType()),
     T.StructField("itm_quantity", T.StringType()),
     T.StructField("itm_amount", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in DISCOUNT_CODE_COLUMNS]
    + [T.StructField("orig_tran_id", T.StringType())])
MISSED_COLUMNS = MISSED_SCHEMA.fieldNames()

# loyalty transaction table (identity key from 1001, defaults on audit columns)
LOYALTY_TXN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("memberid", T.IntegerType()),
    T.StructField("benefitid", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("referencenumber", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("channel", T.StringType()),
    T.StructField("store", T.StringType()),
    T.StructField("associate", T.StringType()),
    T.StructField("monetaryamount", T.FloatType()),
    T.StructField("currency", T.StringType()),
    T.StructField("points", T.IntegerType()),
    T.StructField("expirydate", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("createdat", T.TimestampNTZType()),
    T.StructField("lastupdatedat", T.TimestampNTZType()),
    T.StructField("lastupdatedby", T.StringType()),
])
LOYALTY_TXN_COLUMNS = LOYALTY_TXN_SCHEMA.fieldNames()
LOYALTY_TXN_ID_START = 1001

MEMBER_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("consumerid", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("lastupdatedat", T.TimestampNTZType()),
    T.StructField("lastupdatedby", T.StringType()),
])

MEMBER_ALT_ID_SCHEMA = T.StructType([
    T.StructField("memberid", T.IntegerType()),
    T.StructField("altid", T.StringType()),
])

# staged CRM contact file (13 columns, comma separated, header)
CONTACT_STAGE_SCHEMA = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("altid", T.StringType()),
    T.StructField("idtype", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("preferredlanguage", T.StringType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("birthday", T.StringType()),
    T.StructField("joindate", T.TimestampNTZType()),
    T.StructField("totalpoints", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("segmentcode", T.StringType()),
    T.StructField("lastupdatedby", T.StringType()),
])

# the contact target layout, with its declared constraints and defaults
CONTACT_SCHEMA = T.StructType([
    T.StructField("email", T.StringType()),            # NOT NULL, UNIQUE
    T.StructField("consumerid", T.StringType()),       # UNIQUE
    T.StructField("shopid", T.StringType()),         # UNIQUE
    T.StructField("altid", T.StringType()),
    T.StructField("idtype", T.StringType()),
    T.StructField("country", T.StringType()),          # NOT NULL
    T.StructField("preferredlanguage", T.StringType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("birthday", T.StringType()),
    T.StructField("joindate", T.TimestampNTZType()),
    T.StructField("subscribedate", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("totalpoints", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("segmentcode", T.StringType()),
    T.StructField("crmid_reused", T.BooleanType()),    # DEFAULT false
    T.StructField("createdat", T.TimestampNTZType()),  # DEFAULT now
    T.StructField("lastupdatedat", T.TimestampNTZType()),  # DEFAULT now
    T.StructField("lastupdatedby", T.StringType()),
])
CONTACT_NOT_NULL = ["email", "country"]
CONTACT_UNIQUE = ["email", "consumerid", "shopid"]

# staged CRM account-transaction file (16 columns, comma separated, header)
ACCOUNT_TXN_SCHEMA = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("altid", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("accounttransactionid", T.StringType()),
    T.StructField("rulesourceactionloyaltyzonecode", T.StringType()),
    T.StructField("accounttransactiondate", T.TimestampNTZType()),
    T.StructField("accounttransactionvaluevaliditystartdate", T.StringType()),
    T.StructField("accounttransactionvaluevalidityenddate", T.StringType()),
    T.StructField("accounttransactionvalue", T.IntegerType()),
    T.StructField("accounttransactionvalueavailability", T.StringType()),
    T.StructField("isdeleted", T.StringType()),
    T.StructField("deleteddate", T.TimestampNTZType()),
    T.StructField("createddate", T.TimestampNTZType()),
    T.StructField("updateddate", T.TimestampNTZType()),
    T.StructField("segmentcode", T.StringType()),
    T.StructField("lastupdatedby", T.StringType()),
])

PROFILE_DIM_SCHEMA = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("email_address", T.StringType()),
    T.StructField("active_flag", T.IntegerType()),
    T.StructField("is_disabled", T.IntegerType()),
    T.StructField("last_update_ts", T.TimestampNTZType()),
])

WEB_USER_SCHEMA = T.StructType([T.StructField("p_uid", T.StringType())])
CRM_CONTACT_SCHEMA = T.StructType([T.StructField("email", T.StringType()),
                                   T.StructField("loyaltyzonecode", T.StringType())])
SOURCE_PROFILE_SCHEMA = T.StructType([T.StructField("uuid", T.StringType()),
                                      T.StructField("email", T.StringType())])
