"""End-to-end layered flow through the table store (Bronze → Silver → Gold).

Bronze: the raw listing feed arrives in two time-sliced batches (before / from 1998);
the first is written, the second upserted with ordered duplicate resolution (latest
month wins, W4). Silver: typed once with cast-error capture, good and rejected rows as two
slots of one write; rejects go on to the quarantine log as one batch. Gold: date keys checked against
the calendar dimension (FK orphans must be 0), then a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.functions.dates import date_key
from medalloy.operators import checks as ck
from medalloy.operators import conform as cf
from medalloy.operators import upsert as up
from medalloy.plans.conform_plans import FEED_SPECS, _D_TYPED, _DUCK_FEED, raw_feed
from medalloy.plans.registry import plan
from medalloy.plans.tables import read
from medalloy.sources import files as fs
from medalloy.sources.calendar import calendar_for
from medalloy.store import TableStore, hash_slot

KEYS = ["l_orderkey", "l_linenumber"]

_DEDUPED = f"""(SELECT * EXCLUDE (rn) FROM (
   SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY month_date_yyyymm DESC NULLS LAST, quantity DESC NULLS LAST, extended_price DESC NULLS LAST,
              tax DESC NULLS LAST) AS rn
   FROM ({_DUCK_FEED})) WHERE rn = 1)"""


@plan("listing_flow", "S5 W1 W4 W5 W8 W10 W11 Q1 Q3 Q5 Q6 J8", oracle=f"""
WITH {_D_TYPED.replace(f"FROM ({_DUCK_FEED})", f"FROM {_DEDUPED}")}
SELECT l_orderkey, l_linenumber,
       CAST(year(month_end) * 10000 + month(month_end) * 100 + day(month_end) AS INTEGER) AS date_key,
       month_end, quantity, extended_price, tax
FROM typed WHERE errs = ''
""")
def listing_flow(spark, sf_dir):
    store = TableStore(spark, fs.staging_path(spark, "layers"))
    raw = raw_feed(spark, sf_dir)
    # Bronze: two time slices; later batch wins, duplicates inside a batch resolved by month
    early = F.coalesce(F.col("month_date_yyyymm") < "1998", F.lit(False))  # a null month is in the second slice
    first, second = raw.where(early), raw.where(~early)
    store.write("bronze_listing", up.dedupe(first, KEYS, ["month_date_yyyymm"]), slot=hash_slot(KEYS))
    store.upsert("bronze_listing", second, KEYS, order=["month_date_yyyymm"], resolve_duplicates=True)
    bronze = store.read("bronze_listing")
    # Silver: typed once, both branches in one write
    typed = cf.type_columns(bronze.withColumn("_raw", F.struct(*bronze.columns)), FEED_SPECS, keep=[*KEYS, "_raw"])
    staged = typed.withColumn("quarantine_reason", cf.quarantine_reason()).withColumn("reason", F.col("quarantine_reason"))
    store.write("silver_listing", staged, slot=F.when(F.col("reason").isNull(), "good").otherwise("bad"))
    good, bad = store.read("silver_listing", ["good"]), store.read("silver_listing", ["bad"])
    q = cf.quarantine_rows(bad, source_system="listing", natural_key_cols=KEYS, payload=F.col("_raw"))
    store.append("quarantine", q, batch="listing")
    # Gold: FK check against the calendar dimension, then a full rebuild
    silver = good.withColumn("date_key", date_key("month_end"))
    cal = calendar_for(read(spark, sf_dir, "lineitem"), "l_shipdate").select("date_key")
    ck.enforce(ck.orphans(silver, cal, "date_key"), "gold_listing.date_key")
    store.write("gold_listing", silver.select(*KEYS, "date_key", "month_end", "quantity", "extended_price", "tax"))
    return store.read("gold_listing")
