"""Bank tables derived from the driver's order/lineitem parquet files (see FIXTURES.md).

Every log row is a narrow function of one input row: no join and no shuffle is
spent on building the logs. Opening and closing moments are functions of the
customer key, so the lifetime filter needs no lookup either.
"""

from __future__ import annotations

from datetime import datetime
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.functions.activity import moves_money, succeeded
from bankpulse.params import AnalysisParams, timestamp
from bankpulse.tables import BankTables
from bankpulse.vocabulary import CATEGORIES

PARAMS = AnalysisParams(datetime(1995, 1, 1), datetime(2000, 12, 31, 23, 59, 59), 90)

#: Moments are whole seconds from the first day until the log is complete.
_OPENED_AT = "(k * 7 % 2200 * 86400L + k * 7919 % 86400)"
_OPENED = "timestamp_ntz'1995-01-01 00:00:00' + interval '1' day * cast(k * 7 % 2200 as int) + interval '1' second * cast(k * 7919 % 86400 as int)"
_CLOSED = f"case when k % 19 = 0 then {_OPENED} + interval '400' day end"
_INPUT = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}
_LOG_COLUMNS = [field.split()[0] for field in schemas.OPERATION_LOG.split(", ")]


def _pick(words: list[str], index: str) -> str:
    quoted = ", ".join(f"'{word}'" for word in words)
    return f"elt(cast({index} as int) + 1, {quoted})"


def _after(day: str, seconds: str) -> str:
    return f"datediff(cast({day} as date), date'1995-01-01') * 86400L + ({seconds}) % 86400"


def _check_digit(body: str) -> str:
    """Check digit of a 15-digit body, written out position by position."""
    terms = []
    for position in range(1, 16):
        digit = f"cast(substr({body}, {position}, 1) as int)"
        terms.append(f"({digit} * 2 - if({digit} > 4, 9, 0))" if position % 2 else digit)
    return f"(10 - ({' + '.join(terms)}) % 10) % 10"


def _card(body: str) -> str:
    return f"concat({body}, cast({_check_digit(body)} as string))"


_OPEN: WeakKeyDictionary[SparkSession, dict[tuple[str, bool], ParquetFixture]] = WeakKeyDictionary()


def open_fixture(spark: SparkSession, folder: str, defects: bool = False) -> ParquetFixture:
    """The fixture of a folder; its table definitions are shared by all queries of a session."""
    opened = _OPEN.setdefault(spark, {})
    key = (folder, defects)
    if key not in opened:
        opened[key] = ParquetFixture(spark, folder, defects)
    return opened[key]


class ParquetFixture(BankTables):
    """``defects`` adds the seeded transaction faults that integrity checks must find."""

    def __init__(self, spark: SparkSession, folder: str, defects: bool = False) -> None:
        super().__init__(spark)
        self.folder = folder
        self.defects = defects
        self._customers: int | None = None

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.define(name, lambda: self.spark.read.schema(_INPUT[name]).parquet(path))

    def customer_count(self) -> int:
        """One number, read from the file footers once per session."""
        if self._customers is None:
            self._customers = self.raw("customer").count()
        return self._customers

    # ------------------------------------------------------------------ CRM export
    def staging(self) -> DataFrame:
        return self.define("staging", self._staging)

    def _staging(self) -> DataFrame:
        # the customers may be one row group, which one task would read
        customers = self.raw("customer").repartition(self.spark.sparkContext.defaultParallelism)
        people = customers.selectExpr("c_custkey as k", "c_nationkey as nk", "c_mktsegment as seg").selectExpr(
            "k", "nk", "seg",
            f"{_pick(['Alice', 'Bruno', 'Chloe', 'David', 'Emma'], 'k % 5')} as fn",
            f"concat('Nom', {_pick(['martin', 'durand', 'petit'], 'nk % 3')}) as ln",
            f"{_pick(['Paris', 'Lyon', 'Lille', 'Nice', 'Saint-Étienne'], 'nk % 5')} as ct",
            "date_add(date'1935-01-01', cast(k * 37 % 14000 as int)) as bd",
            "timestamp_ntz'1996-01-01 00:00:00' + interval '1' day * cast(k % 1800 as int) + interval '1' second * cast(k * 101 % 86400 as int) as up",
        ).withColumn("em", F.expr("concat(lower(fn), '.', k, '@example.com')"))
        versions = people.withColumn(
            "version",
            F.explode(F.expr(
                "filter(array('current', if(k % 25 = 0, 'older', null), if(k % 200 = 1, 'copy', null),"
                " if(k % 90 = 17, 'no id', null), if(k % 130 = 21, 'no channel', null), if(k % 170 = 33, 'no moment', null)),"
                " v -> v is not null)"
            )),
        ).withColumn("older", F.expr("version = 'older'"))
        mobile = _pick(["mobile", "Mobile", "MOBILE", "app mobile", "mobile_app"], "k % 5")
        web = _pick(["web", "Web", "WEB", "site web"], "k % 4")
        partner = _pick(["partner", "Partner", "PARTENAIRE", "partenaire"], "k % 4")
        alias = _pick(["St-Etienne", "Saint Etienne", "saint-etienne"], "k % 3")
        return versions.selectExpr(
            "case version when 'no id' then concat('C-', k) when 'no channel' then cast(900000000 + k as string)"
            " when 'no moment' then cast(800000000 + k as string) else concat(if(k % 50 = 3, ' ', ''), 10001 + k) end as crm_customer_id",
            "case when k % 17 = 0 then lower(fn) when k % 20 = 1 then concat(' ', fn, '  ') else fn end as first_name",
            "case when k % 10 = 2 then upper(ln) else ln end as last_name",
            "case when older then replace(em, '@', '.old@') when k % 16 = 4 then upper(em)"
            " when k % 33 = 8 then concat(' ', em, ' ') when k % 100 = 9 then replace(em, '@', ' at ') else em end as email",
            "case when k % 40 = 5 then '' when k % 150 = 7 then '1900-01-01' when k % 150 = 57 then '14/05/2031'"
            " when k % 4 = 1 then date_format(bd, 'dd/MM/yyyy') else date_format(bd, 'yyyy-MM-dd') end as birth_date",
            f"case when older then ct when k % 100 = 11 then '' when nk % 5 = 4 and k % 2 = 0 then {alias}"
            " when k % 12 = 0 then upper(ct) when k % 25 = 6 then concat(lower(ct), ' ') else ct end as city",
            f"case when version = 'no channel' then 'fax' when seg in ('BUILDING', 'MACHINERY') then {mobile}"
            f" when seg in ('AUTOMOBILE', 'FURNITURE') then {web} else {partner} end as signup_channel",
            "if(version = 'no moment', 'soon', cast(if(older, up - interval '200' day, up) as string)) as updated_at",
        )

    # ------------------------------------------------------------------ accounts
    def accounts(self) -> DataFrame:
        return self.define("accounts", self._accounts)

    def _accounts(self) -> DataFrame:
        holder = "if(k % 701 = 700, k - 1, k)"
        return (
            self.raw("customer")
            .selectExpr("c_custkey as k")
            .selectExpr("k", f"concat('400000', lpad({holder}, 9, '0')) as body")
            .selectExpr("k", "body", f"{_check_digit('body')} as digit")
            .selectExpr(
                "k + 1 as account_id",
                "10001 + k - if(k % 17 = 16, 1, 0) as customer_id",
                "concat(body, cast(if(k % 101 = 100, (digit + 1) % 10, digit) as string)) as card_number",
                "'x' as pin_hash",
                "if(k % 19 = 0, 'CLOSED', 'ACTIVE') as status",
                f"{_OPENED} as opened_at",
                f"{_CLOSED} as closed_at",
            )
        )

    def accounts_with_balance(self) -> DataFrame:
        """Balances are the full-history movements, off by one cent on some accounts."""
        from bankpulse.operators.activity import movements

        seeded = open_fixture(self.spark, self.folder, defects=True)
        flows = (
            movements(seeded.transactions())
            .groupBy("account_id")
            .agg(F.sum(F.col("amount_in") - F.col("amount_out")).alias("net"))
        )
        joined = self.accounts().join(flows, "account_id", "left")
        balance = F.coalesce(F.col("net"), F.lit(0)) + F.expr("if(account_id % 97 = 0, 0.01, 0.00)")
        return joined.withColumn("balance", balance.cast("decimal(12,2)")).select(
            "account_id", "customer_id", "card_number", "pin_hash", "balance", "status", "opened_at", "closed_at"
        )

    # ------------------------------------------------------------------ operations
    def operation_log(self, until: datetime | None = None) -> DataFrame:
        return self._operations(until).select(*_LOG_COLUMNS)

    def transactions(self, until: datetime | None = None) -> DataFrame:
        target = (F.col("account_id") + 6) % self.customer_count() + 1
        event = F.col("event_type")
        amount = F.col("amount_requested")
        if self.defects:
            amount = (amount + F.expr("if(operation_id % 1013 = 0, 1.00, 0.00)")).cast("decimal(12,2)")
        rows = self._operations(until).where(succeeded() & moves_money())
        if self.defects:
            rows = rows.where("operation_id % 1019 <> 0")
        return rows.select(
            F.col("operation_id").alias("transaction_id"),
            "operation_id",
            event.alias("txn_type"),
            F.when(event != "DEPOSIT", F.col("account_id")).alias("from_account_id"),
            F.when(event == "DEPOSIT", F.col("account_id")).when(event == "TRANSFER", target).alias("to_account_id"),
            amount.alias("amount"),
            "merchant_category",
            "created_at",
        )

    def _operations(self, until: datetime | None) -> DataFrame:
        return self.define(("operations", until), lambda: self._all_operations(until))

    def _all_operations(self, until: datetime | None) -> DataFrame:
        parts = [self._account_events(), self._order_events(until), self._card_events(until)]
        return _in_lifetime(parts[0].unionByName(parts[1]).unionByName(parts[2]), until)

    def _account_events(self) -> DataFrame:
        first_deposit = "opened + k % 12 * 86400 + 300"
        no_amount = "cast(null as decimal(12,2))"
        return (
            self.raw("customer")
            .selectExpr("c_custkey as k")
            .selectExpr("k", f"{_OPENED_AT} as opened")
            .selectExpr(
                "k",
                f"stack(3, 3, 'CREATE_ACCOUNT', 'APP', {no_amount}, opened, true,"
                f" 4, 'CLOSE_ACCOUNT', 'APP', {no_amount}, opened + 400 * 86400, k % 19 = 0,"
                " 5, 'DEPOSIT', if(k % 3 = 0, 'SEPA', 'APP'), cast(500 + k * 13 % 4000 as decimal(12,2)),"
                f" {first_deposit}, k % 5 < 3 and k % 11 <> 0)"
                " as (tag, event_type, channel, amount_requested, at, happens)",
            )
            .where("happens")
            .selectExpr(
                "k", "8 * k + tag as operation_id", "k + 1 as account_id", "event_type", "'SUCCESS' as status",
                "cast(null as string) as failure_reason", "channel", "amount_requested", "at",
                "cast(null as string) as merchant_category",
            )
        )

    def _order_events(self, until: datetime | None) -> DataFrame:
        orders = self.raw("orders")
        if until is not None:  # an operation happens on its order date or later that day
            orders = orders.where(F.col("o_orderdate") <= timestamp(until))
        never_funded = "o_custkey % 11 = 0 and o_orderkey % 6 in (2, 3)"  # what would be a deposit is a login
        event = _pick(["LOGIN", "BALANCE_INQUIRY", "DEPOSIT", "DEPOSIT", "TRANSFER", "WITHDRAWAL"], "kind")
        login_reason = _pick(["INVALID_CARD_NUMBER", "UNKNOWN_CARD", "WRONG_PIN", "ACCOUNT_CLOSED"], "o div 6 % 4")
        transfer_reason = _pick(
            ["INVALID_CARD_NUMBER", "SAME_ACCOUNT", "UNKNOWN_CARD", "ACCOUNT_CLOSED", "INSUFFICIENT_FUNDS"], "o % 5"
        )
        return (
            orders.selectExpr(
                "o_orderkey as o", "o_custkey as k", "o_totalprice", "o_orderdate",
                f"cast(if({never_funded}, 0, o_orderkey % 6) as int) as kind",
                f"o_orderstatus = 'P' and (o_orderkey % 6 in (0, 4, 5) or o_orderkey % 30 = 20) and not ({never_funded}) as refused",
            )
            .selectExpr(
                "k", "8 * o + 1 as operation_id",
                "if(refused and kind = 0 and o div 6 % 4 < 2, null, k + 1) as account_id",
                f"{event} as event_type", "if(refused, 'FAILED', 'SUCCESS') as status",
                f"case when not refused then null when kind = 0 then {login_reason} when kind = 4 then {transfer_reason}"
                " when kind = 5 then 'INSUFFICIENT_FUNDS' else 'INVALID_AMOUNT' end as failure_reason",
                "if(kind = 3, 'SEPA', 'APP') as channel",
                "case when kind < 2 then null when kind = 2 and refused then cast(0 as decimal(12,2))"
                " else cast(cast(floor(o_totalprice) as decimal(12,0)) * 0.01 as decimal(12,2)) end as amount_requested",
                f"{_after('o_orderdate', 'o * 53')} as at",
                "cast(null as string) as merchant_category",
            )
        )

    def _card_events(self, until: datetime | None) -> DataFrame:
        lines = self.raw("lineitem")
        if until is not None:  # same reasoning as for orders
            lines = lines.where(F.col("l_shipdate") <= timestamp(until))
        declined = "(l_returnflag = 'R' and l_linestatus = 'O')"
        mix = "(l_partkey * 8191 + l_suppkey * 611 + cast(l_quantity as bigint) * 31) % 262144"
        codes = [code for code, _, _ in CATEGORIES]
        seconds = "l_orderkey * 37 + l_partkey * 101 + l_linenumber * 7919"
        return lines.withColumn("k", F.col("l_orderkey") % self.customer_count()).selectExpr(
            "k", f"8 * ((l_orderkey * 8 + l_linenumber) * 262144 + {mix}) + 2 as operation_id",
            "k + 1 as account_id", "'CARD_PAYMENT' as event_type",
            f"if({declined}, 'FAILED', 'SUCCESS') as status",
            f"if({declined}, 'INSUFFICIENT_FUNDS', null) as failure_reason",
            "'CARD_NETWORK' as channel",
            "cast(cast(floor(l_extendedprice / 10) as decimal(12,0)) * 0.01 as decimal(12,2)) as amount_requested",
            f"{_after('l_shipdate', seconds)} as at",
            f"{_pick(codes, 'l_partkey % 9')} as merchant_category",
        )

    # ------------------------------------------------------------------ attempts
    def login_attempts(self) -> DataFrame:
        """Every order as a login: the typed card and whether the PIN was right (or not known)."""
        orders = self.raw("orders").selectExpr(
            "o_orderkey as o", "o_custkey + 1 as account_id",
            "if(o_orderkey % 23 = 7, null, o_orderstatus <> 'P') as pin_ok",
        )
        stranger = _card("concat('400000', lpad(900000000 + o, 9, '0'))")
        cards = self.accounts().select("account_id", "card_number")
        return orders.join(cards, "account_id").selectExpr(
            "o as attempt_id",
            f"case o % 5 when 0 then {_mistyped('card_number')} when 1 then {stranger}"
            " when 2 then substr(card_number, 1, 15) else card_number end as card_input",
            "pin_ok",
        )

    def transfer_attempts(self) -> DataFrame:
        """Every order as a transfer: sender, typed target card and amount; some senders have no
        account, some amounts are missing."""
        orders = self.raw("orders").selectExpr(
            "o_orderkey as o", "o_custkey + 1 as account_id",
            "if(o_orderkey % 25 = 4, cast(0 as decimal(12,2)),"
            " cast(cast(floor(o_totalprice) as decimal(12,0)) * 0.01 as decimal(12,2))) as amount",
        ).withColumn("target_id", (F.col("account_id") + 6) % self.customer_count() + 1)
        stranger = _card("concat('400000', lpad(900000000 + o, 9, '0'))")
        cards = self.accounts().select("account_id", "card_number")
        targets = cards.toDF("target_id", "target_card")
        return (
            orders.join(cards, "account_id")
            .join(targets, "target_id")
            .selectExpr(
                "o as attempt_id", "if(o % 37 = 5, -o, account_id) as sender_id",
                f"case o % 7 when 0 then {_mistyped('target_card')} when 1 then card_number"
                f" when 2 then {stranger} else target_card end as card_input",
                "if(o % 29 = 11, null, amount) as amount",
            )
        )

    def ledger_attempts(self) -> DataFrame:
        """Deposits, debits, sent and received transfers. Whether the funds sufficed is decided
        anew; attempts refused for other reasons never reached the ledger."""
        judged = F.col("failure_reason").isNull() | F.col("failure_reason").isin("INSUFFICIENT_FUNDS", "INVALID_AMOUNT")
        asked = (
            self.operation_log()
            .where(moves_money() & judged & F.col("account_id").isNotNull())
            .select("operation_id", "account_id", "event_type", F.col("amount_requested").alias("amount"), "created_at")
        )
        received = self.transactions().where("txn_type = 'TRANSFER'").select(
            "operation_id", F.col("to_account_id").alias("account_id"), F.lit("TRANSFER_IN").alias("event_type"), "amount", "created_at"
        )
        return asked.unionByName(received)


def _in_lifetime(log: DataFrame, until: datetime | None) -> DataFrame:
    """Every event inside its account's lifetime: one before the opening is mirrored to after it,
    within the period; one after the closing is refused. Events of chosen ids stay as they are:
    the faults that integrity checks find. Events only move later, so bounds on their day of
    origin remain valid for the scan. The moment is made last, from its seconds.

    The moment is exploded from an array of one, for filters on it, or on the outcome, to stay above:
    pushed to the scan, each would repeat all that the moment is made of, and the generated method pass
    the 8000 bytes above which the JVM interprets it for every row."""
    opened = _OPENED_AT
    last = (PARAMS.period_end - datetime(1995, 1, 1)).days * 86400 + 86399
    mirrored = f"{opened} + ({opened} - at) % greatest(86400, {last} - {opened})"
    moved = log.withColumn("at", F.explode(F.array(F.expr(f"if(at < {opened} and operation_id % 211 <> 0, {mirrored}, at)"))))
    if until is not None:
        moved = moved.where(F.col("at") <= int((until - datetime(1995, 1, 1)).total_seconds()))
    late = f"k % 19 = 0 and at > {opened} + 400 * 86400 and operation_id % 211 <> 0"
    return (
        moved.withColumn("late", F.expr(late))
        .withColumn("failure_reason", F.expr("if(late and status = 'SUCCESS', 'ACCOUNT_CLOSED', failure_reason)"))
        .withColumn("status", F.expr("if(late, 'FAILED', status)"))
        .withColumn("created_at", F.expr("timestamp_ntz'1995-01-01 00:00:00' + interval '1' second * cast(at as int)"))
        .drop("at", "late")
    )


def _mistyped(card: str) -> str:
    return f"concat(substr({card}, 1, 15), cast((cast(substr({card}, 16, 1) as int) + 1) % 10 as string))"
