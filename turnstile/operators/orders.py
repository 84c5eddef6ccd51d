"""Order-level facts: latest payment, buyer, ticket counts and paid stubs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from turnstile.functions.labels import APPLICATION_FEE, INACTIVE_STATUSES
from turnstile.functions.values import blank_to_null, safe_int
from turnstile.session import by_key, stage


_STATE = "struct<ok:boolean,at:string,ord:bigint>"
_SLICE = (f"struct<highest:string,settling:string,before_ok:string,has_ok:boolean,"
          f"start:{_STATE},from_ok:{_STATE},from_highest:{_STATE}>")
_SLICES = f"_key string, _part int, slice {_SLICE}, top string, ord bigint"
# The payment that stands, or the slice that settles the order and the date it was entered with.
_STANDING = "struct<ok:boolean,at:string,ord:bigint,part:int,entered:string>"


def _next(state: tuple | None, row: tuple) -> tuple:
    """The payment (approved, date, position) that stands after ``row``."""
    replaces = state is None or (row[0] and not state[0]) or (
        row[1] is not None and state[1] is not None and row[1] > state[1])
    return row if replaces else state


class _Slice:
    """The payments of one order in one partition, read in order, as a map between states.

    A dated state that a slice replaces by a later date goes through each further new highest
    date of the slice, unless an approved payment without a date takes its place before: that
    one settles the order for good. So whatever comes in, at most four states come out: the
    incoming one, ``start`` (nothing came in), ``from_ok`` (replaced by the first approved
    payment) or ``from_highest`` (by a later date), or else the order is settled here, which the
    highest date with a settling payment behind it (``settling``) tells.
    """

    def __init__(self, key: str, part: int):
        self.key, self.part = key, part
        self.start = self.from_ok = self.from_highest = None
        self.highest = self.settling = self.before_ok = None
        self.has_ok = False

    def add(self, row: tuple) -> bool:
        """Read one payment; tells whether it settles the order behind the highest date."""
        ok, at, _ = row
        self.start = _next(self.start, row)
        if not self.has_ok and not ok and at is not None:
            self.before_ok = at if self.before_ok is None else max(self.before_ok, at)
        if self.has_ok or ok:
            self.from_ok = _next(self.from_ok, row)
        self.has_ok = self.has_ok or ok
        if at is not None and (self.highest is None or at > self.highest):
            self.highest, self.from_highest = at, row
        elif self.from_highest is not None:
            before = self.from_highest
            self.from_highest = _next(before, row)
            if self.from_highest is not before and at is None:
                self.settling = self.highest
                return True
        return False

    def row(self) -> dict:
        state = lambda s: s and dict(zip(("ok", "at", "ord"), s, strict=True))
        return {"_key": self.key, "_part": self.part, "top": None, "ord": None, "slice": {
            "highest": self.highest, "settling": self.settling, "before_ok": self.before_ok,
            "has_ok": self.has_ok, "start": state(self.start), "from_ok": state(self.from_ok),
            "from_highest": state(self.from_highest)}}


def _read_slices(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The slices of one sorted partition, each held as a few values however long it is."""
    held = None
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("_key", "_part", "_ok", "_at", "_ord"))
        for key, part, *row in zip(*columns, strict=True):
            if held is None or held.key != key:
                if held is not None:
                    out.append(held.row())
                held = _Slice(key, part)
            if held.add(tuple(row)):
                out.append({"_key": key, "_part": part, "slice": None, "top": held.highest,
                            "ord": row[2]})
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([held.row()], schema=schema)


def _through(state: Column, part: Column, piece: Column) -> Column:
    """The state after a slice (``_Slice``), from the state before it."""
    def standing(s: Column) -> Column:
        return F.when(s.isNotNull(), F.struct(
            s["ok"].alias("ok"), s["at"].alias("at"), s["ord"].alias("ord"),
            F.lit(None).cast("int").alias("part"), F.lit(None).cast("string").alias("entered")))

    settled = F.struct(
        F.lit(True).alias("ok"), F.lit(None).cast("string").alias("at"),
        F.lit(None).cast("bigint").alias("ord"), part.alias("part"), state["at"].alias("entered"))
    later = F.coalesce(state["at"] < F.when(state["ok"], piece["highest"]).otherwise(
        piece["before_ok"]), F.lit(False))
    settles = F.coalesce(state["at"] < piece["settling"], F.lit(False))
    return (F.when(state.isNull(), standing(piece["start"]))
            .when(later & settles, settled)
            .when(later, standing(piece["from_highest"]))
            .when(~state["ok"] & piece["has_ok"], standing(piece["from_ok"]))
            .otherwise(state))


def _standing_payments(pays: DataFrame) -> DataFrame:
    """(_key, _ord) of the payment that stands at the end of each order, for any dates.

    Payments are range-sorted, so an order may span many partitions. Each partition's slice of
    an order becomes a map of fixed size between states; an order has as many maps as
    partitions, and they are folded in order in one aggregate. Where a slice settles the order,
    its settling payment is looked up by the date it was entered with. The number of rounds is
    fixed, whatever the payments.
    """
    ordered = pays.select("_key", "_ord", "_ok", "_at").repartitionByRange(
        "_key", "_ord").sortWithinPartitions("_key", "_ord")
    schema = to_arrow_schema(StructType.fromDDL(_SLICES))
    slices = stage(ordered.withColumn("_part", F.spark_partition_id()).mapInArrow(
        lambda batches: _read_slices(batches, schema), _SLICES), "payment-slices")
    state = stage(slices.where("slice IS NOT NULL").groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("_part", "slice"))).alias("slices")).select(
        "_key", F.aggregate("slices", F.lit(None).cast(_STANDING), lambda s, x: _through(
            s, x["_part"], x["slice"])).alias("s")).select("_key", "s.*"), "payment-states")
    settled = state.where("part IS NOT NULL").select("_key", F.col("part").alias("_part"), "entered")
    looked_up = slices.where("slice IS NULL").join(by_key(settled), ["_key", "_part"]).where(
        "top > entered").groupBy("_key").agg(F.min_by("ord", "top").alias("_ord"))
    return state.where("part IS NULL").select("_key", F.col("ord").alias("_ord")).unionByName(looked_up)


def latest_payment_per_order(payments: DataFrame, order_col: str = "app_order_id") -> DataFrame:
    """The payment that stands for each order.

    The rule reads payments in input order: an approved one replaces one that is not, and
    otherwise a later date (compared as text) replaces an earlier one, whatever its status.
    One hash aggregate settles every order whose outcome does not depend on the order of
    rows beyond what a maximum can tell:

    * an approved payment holding the latest date always stays;
    * so does the first payment of the latest date if no approved one follows it;
    * without any dates the first approved payment stays, else the first.

    Only the rest, if any, is folded payment by payment.
    """
    pays = payments.where(F.length(F.col(order_col)) > 0).select(
        F.col(order_col).alias("_key"),
        "_ord",
        F.coalesce(F.col("status") == "APPROVED", F.lit(False)).alias("_ok"),
        blank_to_null(F.col("payment_datetime").cast("string")).alias("_at"),
        F.struct("_ord", "status", "total_quantity", "product_name", "payment_datetime")
        .alias("_pay"),
    )
    ok, pos = F.col("_ok"), F.col("_ord")
    whole = F.struct("_pay", "_ok")
    stats = stage(pays.groupBy("_key").agg(
        F.count("*").alias("_n"),
        F.count("_at").alias("_dated"),
        F.max_by(whole, F.struct("_at", "_ok", -pos)).alias("_top"),
        F.max(F.when(ok, pos)).alias("_last_ok"),
        F.min_by("_pay", "_ord").alias("_first"),
        F.min_by(F.when(ok, F.col("_pay")), F.when(ok, pos)).alias("_first_ok"),
    ), "order-payments")
    settled = (F.col("_dated") == F.col("_n")) & (
        F.col("_top._ok")
        | F.col("_last_ok").isNull()
        | (F.col("_last_ok") < F.col("_top._pay._ord"))
    )
    undated = F.col("_dated") == 0
    decided = stats.where(settled | undated).select(
        "_key",
        F.when(undated, F.coalesce("_first_ok", "_first")).otherwise(F.col("_top._pay"))
        .alias("_pay"),
    )
    open_orders = stats.where(~(settled | undated)).select("_key")
    if not open_orders.isEmpty():
        rest = pays.join(by_key(open_orders), "_key", "left_semi")
        chosen = rest.join(by_key(_standing_payments(rest)), ["_key", "_ord"], "left_semi").select("_key", "_pay")
        decided = decided.unionByName(chosen)
    return decided.select(
        F.col("_key").alias("order_number"),
        F.col("_pay._ord").alias("payment_ord"),
        F.col("_pay.status").alias("order_payment_status"),
        F.col("_pay.total_quantity").alias("total_quantity"),
        F.col("_pay.product_name").alias("product_name"),
        F.col("_pay.payment_datetime").alias("payment_datetime"),
    )


def paid_tickets(total_quantity: Column, product_name: Column) -> Column:
    """Bought ticket count: the quantity without the application-fee line, 0 if unknown."""
    n = safe_int(total_quantity)
    fee = F.coalesce(product_name.contains(APPLICATION_FEE), F.lit(False))
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.when(fee, F.greatest(n - 1, zero)).otherwise(n), zero)


BUYER_FIELDS = (
    "contact_id", "first_name", "last_name", "full_name", "email", "phone", "is_member",
    "member_id",
)


def order_grain(guests: DataFrame) -> DataFrame:
    """Per order: its first BUYER row as a struct, guest counts by type, first position."""
    kind, pos = F.col("guest_type"), F.col("_ord")
    buyer = kind == "BUYER"
    return (
        guests.where(F.length("order_number") > 0)
        .groupBy("order_number")
        .agg(
            F.min_by(F.when(buyer, F.struct(*BUYER_FIELDS)), F.when(buyer, pos)).alias("buyer"),
            F.count_if(buyer).alias("buyers"),
            F.count_if(kind == "TICKET_HOLDER").alias("holders"),
            F.count_if(kind == "RSVP").alias("rsvps"),
            F.min(pos).alias("first_seen"),
        )
        .withColumn("tickets_in_order", F.when(F.col("holders") > 0, F.col("holders")))
    )


def first_buyer(guests: DataFrame) -> DataFrame:
    """The first BUYER row of each order: order_number, guest_id, contact_id."""
    buyers = guests.where((F.col("guest_type") == "BUYER") & (F.length("order_number") > 0))
    return buyers.groupBy("order_number").agg(
        F.min_by(F.struct("guest_id", "contact_id"), "_ord").alias("b")
    ).select("order_number", "b.*")


def is_inactive(status: Column) -> Column:
    return F.coalesce(status.isin(INACTIVE_STATUSES), F.lit(False))


def order_context(guests: DataFrame, payments: DataFrame) -> DataFrame:
    """``order_grain`` with the order's payment, paid ticket count and inactive flag.

    Staged, as the stubs, the paid cut-off, definition matching and the audit all read it.
    """
    joined = order_grain(guests).join(
        by_key(latest_payment_per_order(payments)), "order_number", "left")
    return stage(joined.withColumns({
        "paid_tickets_per_order": paid_tickets(F.col("total_quantity"), F.col("product_name")),
        "inactive": is_inactive(F.col("order_payment_status")),
    }), "order-context")


def stub_key(ticket_number: Column, position: Column) -> Column:
    """Sort key of ticket stubs: numbered first, by number, then input order."""
    number = blank_to_null(ticket_number)
    return F.struct(
        number.isNull().alias("unnumbered"), number.alias("number"), position.alias("ord")
    )


def nth_stub(keys: DataFrame) -> DataFrame:
    """The n-th smallest key per order, from rows (order_number, key, nth); keys are distinct.

    The keys are range-sorted over the cluster and written with a running number. An order then
    lies in neighbouring partitions, however large it is. Counts per (order, partition) tell in
    which partition its n-th key is, and the running number which row that is.
    """
    ordered = stage(
        keys.repartitionByRange("order_number", "key")
        .sortWithinPartitions("order_number", "key")
        .withColumn("_at", F.monotonically_increasing_id()), "ordered-stubs")
    # The number holds the partition in its upper bits, see monotonically_increasing_id.
    parts = ordered.groupBy("order_number", F.shiftright("_at", 33).alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), F.min("nth").alias("nth"))
    through = F.sum("_n").over(Window.partitionBy("order_number").orderBy("_part"))
    before = F.col("_through") - F.col("_n")
    wanted = parts.withColumn("_through", through).where(
        (F.col("nth") > before) & (F.col("nth") <= F.col("_through"))
    ).select("order_number", (F.col("_first") + F.col("nth") - before - 1).alias("_at"))
    return ordered.join(by_key(wanted), ["order_number", "_at"]).select(
        "order_number", F.col("key").alias("last_paid"))


def paid_cutoff(guests: DataFrame, context: DataFrame) -> DataFrame:
    """Per order with some but not all stubs paid: the sort key of its last paid stub."""
    mixed = context.where("paid_tickets_per_order > 0 and paid_tickets_per_order < holders")
    holders = guests.where("guest_type = 'TICKET_HOLDER'").select(
        "order_number", stub_key(F.col("ticket_number"), F.col("_ord")).alias("key")
    )
    return nth_stub(holders.join(
        by_key(mixed.select("order_number", F.col("paid_tickets_per_order").alias("nth"))),
        "order_number"))


def is_paid_stub(guest_type: Column, key: Column) -> Column:
    """Paid flag of a stub joined to its order context; null for anything but a holder."""
    paid, holders = F.col("paid_tickets_per_order"), F.col("holders")
    return F.when(
        guest_type == "TICKET_HOLDER",
        F.when(paid <= 0, False).when(paid >= holders, True).otherwise(key <= F.col("last_paid")),
    )
