"""Sub-ledger histories derived from the driver's tables (SRC2 / JN11 / DQ23).

Five tables of five shapes, each described once (``SUBLEDGERS``): typed columns, the key
(8, 2, 5, 8 and 1 columns) and which columns are company, account, date, amount and cost center.  The
scan, the merge and the normalising union are driven by that description.

PARTHIST-shaped: one row per parts line item and GL account, with the account
(PH_GLIA), the transaction date (PH_DTR, YYYYMMDD) and the net amount (PH_NET).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.columns import case_map
from .adapter import cents_to_amount, line_items, read_source
from .commits import COMPRESSION, once
from .scan import scan_subledger

PARTS_TYPE = "SMALL"


def parts_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts sales and their cost, straight from the line items (not the journal).

    Only what the sub-ledger needs is joined: parts of the parts type (the filter is
    pushed into the part scan before the join) and the supplier's region for the
    company; the orders table is not read."""
    li = read_source(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    p = read_source(spark, sf_dir, "part").where(F.col("p_type") == PARTS_TYPE).select("p_partkey")
    s = read_source(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read_source(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sn = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_regionkey")
    items = li.join(p, li.l_partkey == p.p_partkey).join(sn, li.l_suppkey == sn.s_suppkey)
    ship = F.to_date("l_shipdate")
    c = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    base = items.select(
        F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0").alias("PH_CO"),
        (F.year(ship) * 10000 + F.month(ship) * 100 + F.dayofmonth(ship)).cast("int").alias("PH_DTR"),
        c.alias("c"))
    legs = F.array(
        F.struct(F.lit("33100").alias("PH_GLIA"), (-F.col("c")).alias("cents")),
        F.struct(F.lit("43100").alias("PH_GLIA"),
                 F.expr(f"c * {fixed.COST_NUMERATOR} div {fixed.COST_DENOMINATOR}").alias("cents")))
    out = base.select("PH_CO", "PH_DTR", F.inline(legs))
    return out.select("PH_CO", "PH_GLIA", "PH_DTR", cents_to_amount(F.col("cents")).alias("PH_NET"))


def normalise(parthist: DataFrame) -> DataFrame:
    """(company, account, period, amount) — the common shape of every sub-ledger."""
    return parthist.select(F.col("PH_CO").alias("Company"), F.col("PH_GLIA").alias("AccountNumber"),
                           (F.col("PH_DTR") / 100).cast("int").alias("Period"), F.col("PH_NET").alias("Amount"))


PARTHIST = T.StructType([
    T.StructField("PH_CO", T.StringType()), T.StructField("PH_GLIA", T.StringType()),
    T.StructField("PH_DTR", T.IntegerType()), T.StructField("PH_NET", T.DecimalType(12, 2)),
])


@dataclass(frozen=True)
class SubLedger:
    name: str
    fields: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    company: str
    account: str
    date: str
    amount: str
    center: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in self.fields])

    @property
    def values(self) -> list[str]:
        return [n for n, _ in self.fields if n not in self.keys]


# --- Fixed values: columns and keys of the sub-ledgers (dates are YYYYMMDD) --------------
SUBLEDGERS = {s.name: s for s in (
    SubLedger("CGIHIST", (
        ("CH_CO", "string"), ("CH_DIV", "string"), ("CH_ORD", "string"), ("CH_CGT", "string"), ("CH_CLS", "string"), ("CH_BDT", "int"),
        ("CH_INV", "string"), ("CH_SEQ", "int"), ("CH_CUS", "string"), ("CH_AMT", "decimal(12,2)"), ("CH_ACC", "string"), ("CH_CC", "string"),
        ("CH_BR", "string"), ("CH_UID", "bigint")),
        ("CH_CO", "CH_DIV", "CH_ORD", "CH_CGT", "CH_CLS", "CH_BDT", "CH_INV", "CH_SEQ"), "CH_CO", "CH_ACC", "CH_BDT", "CH_AMT", "CH_CC"),
    SubLedger("YTDIST", (
        ("DN_TID", "bigint"), ("DN_SEQ", "int"), ("DN_CO", "string"), ("DN_VEN", "string"), ("DN_DIV", "string"), ("DN_GRS", "decimal(12,2)"),
        ("DN_ACC", "string"), ("DN_CC", "string"), ("DN_DTI", "int"), ("DN_DTD", "int")),
        ("DN_TID", "DN_SEQ"), "DN_CO", "DN_ACC", "DN_DTI", "DN_GRS", "DN_CC"),
    SubLedger("SUBLED", (
        ("SL_CO", "string"), ("SL_ACC", "string"), ("SL_CC", "string"), ("SL_DIV", "string"), ("SL_SEQ", "bigint"), ("SL_DES", "string"),
        ("SL_IA", "decimal(12,2)"), ("SL_RA", "decimal(12,2)"), ("SL_DTI", "int"), ("SL_SYS", "string")),
        ("SL_CO", "SL_ACC", "SL_CC", "SL_DIV", "SL_SEQ"), "SL_CO", "SL_ACC", "SL_DTI", "SL_IA", "SL_CC"),
    SubLedger("PARTHIST", (
        ("PH_CO", "string"), ("PH_PRT", "string"), ("PH_DIV", "string"), ("PH_BR", "string"), ("PH_DTR", "int"), ("PH_TMR", "int"), ("PH_PO", "string"),
        ("PH_SEQ", "int"), ("PH_NET", "decimal(12,2)"), ("PH_VEN", "string"), ("PH_GLIC", "string"), ("PH_GLIA", "string")),
        ("PH_CO", "PH_PRT", "PH_DIV", "PH_BR", "PH_DTR", "PH_TMR", "PH_PO", "PH_SEQ"), "PH_CO", "PH_GLIA", "PH_DTR", "PH_NET", "PH_GLIC"),
    SubLedger("INVHCC", (
        ("EB_TID", "bigint"), ("EB_CO", "string"), ("EB_DIV", "string"), ("EB_BR", "string"), ("EB_ORD", "string"), ("EB_GLA", "string"),
        ("EB_GLC", "string"), ("EB_DTT", "int"), ("EB_CUS", "string"), ("EB_IAMT", "decimal(12,2)")),
        ("EB_TID",), "EB_CO", "EB_GLA", "EB_DTT", "EB_IAMT", "EB_GLC"),
)}


def numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items with what the five sub-ledgers take from them.  The joins end on the
    order, so the rows of an (order, line) are numbered where they are."""
    ship = F.to_date("l_shipdate")
    day = (F.year(ship) * 10000 + F.month(ship) * 100 + F.dayofmonth(ship)).cast("int")
    kinds = {t: d for t, d, _ in fixed.PART_TYPE_MAP}
    branch = F.lpad((F.col("l_suppkey") % fixed.BRANCH_COUNT + 1).cast("string"), 2, "0")
    # The source repeats (order, line); rows of one get a sequence in the order of their values.
    again = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag")
    return line_items(spark, sf_dir).withColumn("seq", F.row_number().over(again)).select(
        F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0").alias("co"), F.lit("01").alias("div"), branch.alias("br"),
        F.col("l_orderkey").alias("order"), (F.col("l_linenumber") * 1000000 + F.col("seq")).cast("int").alias("line"), day.alias("day"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_suppkey").cast("string").alias("vendor"), F.col("o_custkey").cast("string").alias("customer"),
        case_map(F.col("p_type"), list(kinds.items()), "2").alias("dept"),
        case_map(F.col("p_type"), [(t, a) for t, _, a in fixed.PART_TYPE_MAP], "32000").alias("rev"),
        case_map(F.col("o_orderpriority"), fixed.PRIORITY_EXPENSE_MAP, "58400").alias("exp"), "l_returnflag",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"), F.round(F.col("l_discount") * 100).cast("bigint").alias("dp"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tp"))


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sub-ledger over all line items of its kind (FIXTURES F9): service work by order
    (CGIHIST), vendor distributions of the expense leg (YTDIST), depreciation entries of
    returned lines (SUBLED), parts sales and cost (PARTHIST), equipment invoices (INVHCC).
    The numbered items are written at the first of the five and read by the others; the order
    as text and the id of an (order, line) follow from what is written."""
    from .store import source_root  # the store builds the parts sub-ledger with this module
    x = spark.read.parquet(once(spark, f"{source_root(spark, sf_dir)}/subledgers/items",
                                lambda path: numbered_items(spark, sf_dir).write.parquet(path, compression=COMPRESSION)))
    x = x.select("*", F.col("order").cast("string").alias("ord"), (F.col("order") * 10000000 + F.col("line")).cast("bigint").alias("tid"))
    cost = F.expr(f"c * {fixed.COST_NUMERATOR} div {fixed.COST_DENOMINATOR}")
    sides = F.array(F.struct(F.lit("S").alias("side"), F.col("rev").alias("acc"), (-F.col("c")).alias("cents")),
                    F.struct(F.lit("C").alias("side"), F.concat(F.lit("4"), F.substring("rev", 2, 4)).alias("acc"), cost.alias("cents")))
    two = x.select("*", F.inline(sides))
    money = lambda c: cents_to_amount(c)
    cc = F.concat("dept", "br")
    if name == "CGIHIST":
        out = two.where("dept = '3'").select(
            F.col("co").alias("CH_CO"), F.col("div").alias("CH_DIV"), F.col("ord").alias("CH_ORD"), F.col("side").alias("CH_CGT"), F.lit("L").alias("CH_CLS"),
            F.col("day").alias("CH_BDT"), F.lpad((F.col("order") % 1000000).cast("string"), 6, "0").alias("CH_INV"), F.col("line").alias("CH_SEQ"),
            F.col("customer").alias("CH_CUS"), money(F.col("cents")).alias("CH_AMT"), F.col("acc").alias("CH_ACC"), cc.alias("CH_CC"),
            F.col("br").alias("CH_BR"), F.col("tid").alias("CH_UID"))
    elif name == "YTDIST":
        out = x.select(
            F.col("tid").alias("DN_TID"), F.lit(1).alias("DN_SEQ"), F.col("co").alias("DN_CO"), F.col("vendor").alias("DN_VEN"), F.col("div").alias("DN_DIV"),
            money(F.expr("c * dp div 100")).alias("DN_GRS"), F.col("exp").alias("DN_ACC"), F.concat(F.lit("1"), "br").alias("DN_CC"),
            F.col("day").alias("DN_DTI"), F.col("day").alias("DN_DTD"))
    elif name == "SUBLED":
        amount = money(F.expr("c * tp div 100"))
        out = x.where("l_returnflag = 'R'").select(
            F.col("co").alias("SL_CO"), F.lit(fixed.DEPRECIATION_ACCOUNT).alias("SL_ACC"), F.concat(F.lit("1"), "br").alias("SL_CC"),
            F.col("div").alias("SL_DIV"), F.col("tid").alias("SL_SEQ"), F.lit("depreciation").alias("SL_DES"), amount.alias("SL_IA"),
            amount.alias("SL_RA"), F.col("day").alias("SL_DTI"), F.lit("002").alias("SL_SYS"))
    elif name == "PARTHIST":
        out = two.where("dept = '4'").select(
            F.col("co").alias("PH_CO"), F.col("part").alias("PH_PRT"), F.col("div").alias("PH_DIV"), F.col("br").alias("PH_BR"), F.col("day").alias("PH_DTR"),
            F.when(F.col("side") == "S", 80000).otherwise(170000).cast("int").alias("PH_TMR"), F.col("ord").alias("PH_PO"), F.col("line").alias("PH_SEQ"),
            money(F.col("cents")).alias("PH_NET"), F.col("vendor").alias("PH_VEN"), cc.alias("PH_GLIC"), F.col("acc").alias("PH_GLIA"))
    elif name == "INVHCC":
        out = x.where("dept = '2'").select(
            F.col("tid").alias("EB_TID"), F.col("co").alias("EB_CO"), F.col("div").alias("EB_DIV"), F.col("br").alias("EB_BR"), F.col("ord").alias("EB_ORD"),
            F.col("rev").alias("EB_GLA"), cc.alias("EB_GLC"), F.col("day").alias("EB_DTT"), F.col("customer").alias("EB_CUS"),
            money(-F.col("c")).alias("EB_IAMT"))
    else:
        raise ValueError(f"no sub-ledger is called {name!r}: there are {', '.join(SUBLEDGERS)}")
    return out.select(*[F.col(n).cast(t) for n, t in SUBLEDGERS[name].fields])


def stored_subledger(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC2: typed scan of a sub-ledger, which is derived and written at its first use.

    Rows are in the order of their few-valued columns inside each task: neighbours share them,
    in the files and in every shuffle of rows read from them (the merge of a sub-ledger)."""
    from .store import source_root  # the store builds the parts sub-ledger with this module
    s = SUBLEDGERS[name]
    path = once(spark, f"{source_root(spark, sf_dir)}/subledgers/{name}",
                lambda p: derive(spark, sf_dir, name).sortWithinPartitions(s.company, s.account, s.center, s.date).write.parquet(p, compression=COMPRESSION))
    return scan_subledger(spark, path, s.schema)


def normalised(rows: DataFrame, name: str) -> DataFrame:
    """(table, company, account, period, amount): the common shape of the five."""
    s = SUBLEDGERS[name]
    return rows.select(F.lit(name).alias("TableName"), F.col(s.company).alias("Company"), F.col(s.account).alias("AccountNumber"),
                       F.expr(f"{s.date} div 100").cast("int").alias("Period"), F.col(s.date).cast("int").alias("Date"), F.col(s.amount).alias("Amount"))


def all_subledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ23: the union of the five, normalised; only the four columns are read."""
    out = None
    for name in SUBLEDGERS:
        one = normalised(stored_subledger(spark, sf_dir, name), name)
        out = one if out is None else out.unionByName(one)
    return out
