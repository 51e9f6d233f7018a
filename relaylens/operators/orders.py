"""Order analytics on flattened order documents (FIXTURES F5) and the
aligned event log (F3): enrichment, pair/route summaries, order detail,
leg alignment and the backlog of orders not yet stored.

Scale notes
-----------
* ``enrich_orders`` is a left equi-join on ``orderid``. The event log holds
  one row per id (``align_legs`` guarantees it), so the join never
  multiplies rows; AQE turns it into a broadcast join when the event side
  is measured small and splits skewed partitions otherwise.
* ``pair_analysis``/``chain_analysis`` share one builder for the per-order
  measures; the aggregates are algebraic (count/sum/avg) so a hot pair or
  route is pre-aggregated on the map side.
* ``align_legs`` reduces each leg to one row per id before the full outer
  join, so duplicate ids cannot multiply rows.
* With the chain labels given, ``align_legs`` finds an id's earliest event as the minimum
  of one 64-bit number, so Spark aggregates by hash and sorts nothing before the shuffle.
* ``backlog`` is a plain anti join; AQE can split a hot candidate id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X

# Flattened order-document columns used below.
GIVE_AMOUNT = "giveOfferWithMetadata_finalAmount"
GIVE_DECIMALS = "giveOfferWithMetadata_metadata_decimals"
GIVE_SYMBOL = "giveOfferWithMetadata_metadata_symbol"
TAKE_AMOUNT = "takeOfferWithMetadata_finalAmount"
TAKE_DECIMALS = "takeOfferWithMetadata_metadata_decimals"
TAKE_SYMBOL = "takeOfferWithMetadata_metadata_symbol"
PRE_NAME = "preswapData_tokenInMetadata_name"
PRE_AMOUNT = "preswapData_inAmount"
PRE_DECIMALS = "preswapData_tokenInMetadata_decimals"
MAKER = "makerSrc"
RECEIVER = "receiverDst"

EVENT_COLUMNS = ("orderid", "src_evt_time", "src_chain", "dest_evt_time", "dest_chain")


def enrich_orders(orders: DataFrame, events: DataFrame, key: str = "orderid") -> DataFrame:
    """All orders with their event times and chains where known.

    The event side's columns are prefixed ``ev_`` so both keys survive:
    ``ev_orderid`` is NULL for an order without events.
    """
    ev = events.select(*[F.col(c).alias(f"ev_{c}") for c in events.columns])
    return orders.join(ev, orders[key] == ev[f"ev_{key}"], "left")


def order_measures(orders: DataFrame, events: DataFrame, sentinel_mode: bool = False,
                   positive_only: bool = True) -> DataFrame:
    """Per-order measures shared by the pair and route summaries.

    Columns: ``orderid``, ``src_evt_time``, ``src_chain``, ``dest_chain``,
    ``in_token``, ``out_symbol``, ``amount_in``, ``amount_out``,
    ``final_price``, ``pair``, ``route``, ``usd_price``. Only orders with a
    positive offered amount are kept (F2) unless ``positive_only=False``.

    Everything that depends on the order document alone (amounts, price,
    pair, USD price, the address/symbol chain override) is computed *before*
    the join with the event log, so a shuffled join moves a few narrow
    columns per order instead of the raw document text.
    """
    d = orders.where(X.is_positive(GIVE_AMOUNT)) if positive_only else orders
    d = d.select(
        F.col("orderid").alias("__doc_id"),
        X.chain_override(MAKER, GIVE_SYMBOL).alias("__src_ovr"),
        X.chain_override(RECEIVER, TAKE_SYMBOL).alias("__dest_ovr"),
        X.effective_token(PRE_NAME, GIVE_SYMBOL, sentinel_mode).alias("in_token"),
        F.col(TAKE_SYMBOL).alias("out_symbol"),
        X.effective_amount(PRE_NAME, PRE_AMOUNT, PRE_DECIMALS, GIVE_AMOUNT, GIVE_DECIMALS,
                           sentinel_mode).alias("amount_in"),
        X.scale_amount(TAKE_AMOUNT, TAKE_DECIMALS).alias("amount_out"))
    d = (d.withColumn("final_price", X.safe_divide("amount_out", "amount_in"))
          .withColumn("pair", X.pair_label("in_token", "out_symbol")))
    d = d.withColumn("usd_price", X.usd_price("pair"))
    ev = events.select(F.col("orderid").alias("ev_orderid"), F.col("src_evt_time").alias("ev_src_evt_time"),
                       F.col("src_chain").alias("ev_src_chain"), F.col("dest_chain").alias("ev_dest_chain"))
    j = d.join(ev, d["__doc_id"] == ev["ev_orderid"], "left")
    m = j.select(
        F.col("ev_orderid").alias("orderid"),
        F.col("ev_src_evt_time").alias("src_evt_time"),
        F.coalesce("__src_ovr", "ev_src_chain").alias("src_chain"),
        F.coalesce("__dest_ovr", "ev_dest_chain").alias("dest_chain"),
        "in_token", "out_symbol", "amount_in", "amount_out", "final_price", "pair", "usd_price")
    return m.withColumn("route", X.route_label("src_chain", "dest_chain"))


def _summary(measures: DataFrame, label: str) -> DataFrame:
    return (measures.groupBy(label)
            .agg(F.count(label).alias("tx_count"),
                 F.avg("final_price").alias("avg_price"),
                 F.sum("amount_in").alias("amount_in"),
                 F.sum("amount_out").alias("amount_out"),
                 F.sum(F.col("usd_price") * F.col("amount_out")).alias("volume_usd")))


def pair_analysis(orders: DataFrame, events: DataFrame, sentinel_mode: bool = False) -> DataFrame:
    """Per token pair: transaction count, mean price, total in/out and USD
    volume (A1). ``tx_count`` counts the non-NULL labels."""
    return _summary(order_measures(orders, events, sentinel_mode), "pair")


def chain_analysis(orders: DataFrame, events: DataFrame, sentinel_mode: bool = False) -> DataFrame:
    """The same measures per ``src-dest`` route (A2). Orders whose route is
    unknown form one NULL route whose ``tx_count`` is 0."""
    m = order_measures(orders, events, sentinel_mode).withColumnRenamed("route", "chain")
    return _summary(m, "chain")


def usd_volume(orders: DataFrame, events: DataFrame) -> DataFrame:
    """USD volume per output leg of the pair label with the reference price
    that applies to it (P17, F11)."""
    m = order_measures(orders, events).withColumn("out_leg", X.pair_out_leg("pair"))
    return (m.groupBy("out_leg", "usd_price")
             .agg(F.count(F.lit(1)).alias("orders"),
                  F.sum("amount_out").alias("amount_out"),
                  F.sum(F.col("usd_price") * F.col("amount_out")).alias("volume_usd")))


# Output name -> source column of the order detail projection.
ORDER_DETAIL_COLUMNS = (
    ("USER_IN", MAKER),
    ("AMOUNT_IN", GIVE_AMOUNT),
    ("DECIMAL_IN", GIVE_DECIMALS),
    ("SYMBOL_IN", GIVE_SYMBOL),
    ("TX_HASH_IN", "createdSrcEventMetadata_transactionHash"),
    ("CHAIN_IN", "giveOfferWithMetadata_chainId"),
    ("USER_OUT", RECEIVER),
    ("AMOUNT_OUT", TAKE_AMOUNT),
    ("DECIMAL_OUT", TAKE_DECIMALS),
    ("SYMBOL_OUT", TAKE_SYMBOL),
    ("TX_HASH_OUT", "fulfilledDstEventMetadata_transactionHash"),
    ("CHAIN_OUT", "takeOfferWithMetadata_chainId"),
    ("PRE_SYMBOL_IN", "preswapData_tokenInMetadata_symbol"),
    ("PRE_DECIMAL_IN", PRE_DECIMALS),
    ("PRE_AMOUNT_IN", PRE_AMOUNT),
    ("PRE_AMOUNT_OUT", "preswapData_outAmount"),
    ("PRE_DECIMAL_OUT", "preswapData_tokenOutMetadata_decimals"),
    ("PRE_SYMBOL_OUT", "preswapData_tokenOutMetadata_symbol"),
    ("taker", "taker"),
    ("percentFee", "percentFee"),
    ("FinalpercentFee", "finalPercentFee"),
    ("fixFee", "fixFee"),
    ("state", "state"),
    ("orderMetadata_origin", "orderMetadata_origin"),
    ("orderMetadata_orderTradeType", "orderMetadata_orderTradeType"),
)


def order_details(orders: DataFrame, events: DataFrame) -> DataFrame:
    """30-column order detail (P1): renamed document fields, event times
    and classified chains. ``ORDERID`` comes from the event side, so it is
    NULL for an order without events."""
    j = enrich_orders(orders, events)
    cols = [F.col("ev_orderid").alias("ORDERID")]
    cols += [F.col(src).alias(dst) for dst, src in ORDER_DETAIL_COLUMNS]
    cols += [
        F.col("ev_src_evt_time").alias("SRC_EVT_TIME"),
        X.classify_chain(MAKER, GIVE_SYMBOL, "ev_src_chain").alias("SRC_CHAIN"),
        F.col("ev_dest_evt_time").alias("DEST_EVT_TIME"),
        X.classify_chain(RECEIVER, TAKE_SYMBOL, "ev_dest_chain").alias("DEST_CHAIN"),
    ]
    return j.select(*cols)


def order_lookup(details: DataFrame, order_id: str, key: str = "ORDERID") -> DataFrame:
    """Point lookup by id (F1). Catalyst pushes the equality to both join
    inputs; it reaches the scans if the id is a stored column there (not a
    computed one)."""
    return details.where(X.id_equals(key, order_id))


#: Stands for a missing time in a packed number; no time of a four-digit year is as small.
NO_TIME = -253_402_300_800_000_000
#: So many labels keep (micros, label number) of every four-digit year within 64 bits.
MAX_PACKED_CHAINS = 35


def _packed_event(leg: DataFrame, ts: str, chain: str, chains, time_format: str | None):
    """(packed number of an event, its time and chain again from the column ``e``). Order and
    ties are those of (time, chain), NULLs first."""
    labels = sorted(set(chains))
    if len(labels) > MAX_PACKED_CHAINS:
        raise ValueError(f"at most {MAX_PACKED_CHAINS} chain labels can be packed, not {len(labels)}")
    kind = leg.schema[ts].dataType
    is_text = isinstance(kind, T.StringType)
    if is_text and time_format is None:
        raise ValueError(f"{ts} is text: packing it needs its time_format")
    t = F.to_timestamp_ntz(F.col(ts), F.lit(time_format)) if is_text else F.col(ts)
    micros = F.unix_micros(t.cast("timestamp"))
    if is_text:                                   # a text that its format does not give back would be changed
        same = F.date_format(t, time_format) == F.col(ts)
        micros = F.when(F.col(ts).isNull(), None).when(same, micros).otherwise(
            F.raise_error(F.concat(F.lit(f"{ts} is not in the format {time_format}: "), F.col(ts))).cast("bigint"))
    names = F.array(*[F.lit(x) for x in labels])
    number = F.array_position(names, F.col(chain))
    number = F.when(F.col(chain).isNull(), 0).when(number > 0, number).otherwise(
        F.raise_error(F.concat(F.lit("unknown chain label: "), F.col(chain))).cast("bigint"))
    base = F.lit(len(labels) + 1).cast("bigint")
    packed = F.coalesce(micros, F.lit(NO_TIME).cast("bigint")) * base + number
    n = F.pmod(F.col("e"), base)
    at = F.call_function("div", F.col("e") - n, base)
    back = F.when(at != NO_TIME, F.timestamp_micros(at).cast("timestamp_ntz"))
    back = F.date_format(back, time_format) if is_text else back.cast(kind)
    return packed, back, F.get(names, (n - 1).cast("int"))


def earliest_per_id(leg: DataFrame, key: str, ts: str, chain: str, chains=None,
                    time_format: str | None = None) -> DataFrame:
    """One row per id: the earliest event (ties broken by chain), plus the
    number of events seen. Partial aggregation keeps hot ids cheap.

    With ``chains`` (all chain labels that occur, at most 35) time and chain are packed
    into one number whose minimum a hash aggregate keeps; a label not among them
    fails the job. Times may then be text in ``time_format``, and text in another form fails
    the job too. Without ``chains`` any values go, by a sort-based aggregate.
    """
    if chains is None:
        event, t, c = F.struct(F.col(ts).alias("t"), F.col(chain).alias("c")), F.col("e.t"), F.col("e.c")
    else:
        event, t, c = _packed_event(leg, ts, chain, chains, time_format)
    return (leg.groupBy(key)
               .agg(F.min(event).alias("e"), F.count(F.lit(1)).alias("n"))
               .select(F.col(key), t.alias(ts), c.alias(chain), "n"))


def align_legs(src: DataFrame, dest: DataFrame, key: str = "orderId", ts: str = "evt_time",
               chain: str = "chain", with_counts: bool = False, metrics: dict | None = None,
               chains=None, time_format: str | None = None) -> DataFrame:
    """One row per order id with its source and destination leg.

    Each leg is first reduced to its earliest event per id, so duplicate ids
    cannot multiply rows; the full outer join then always shuffles both
    sides on the id (use pre-partitioned or bucketed inputs when repeated).
    ``chains`` and ``time_format`` are those of :func:`earliest_per_id`.
    With a ``metrics`` dict, Observations ``src_duplicate_ids`` and
    ``dest_duplicate_ids`` (ids seen more than once in a leg) are registered
    in it; they are filled by the first action, without an extra job.
    """
    from pyspark.sql import Observation

    def leg(df, prefix):
        out = earliest_per_id(df.select(key, ts, chain), key, ts, chain, chains, time_format)
        if metrics is not None:
            obs = Observation(f"{prefix}_duplicate_ids")
            out = out.observe(obs, F.count_if(F.col("n") > 1).alias(f"{prefix}_duplicate_ids"))
            metrics[f"{prefix}_duplicate_ids"] = obs
        return out

    s = leg(src, "src").select(
        F.col(key).alias("s_id"), F.col(ts).alias("src_evt_time"),
        F.col(chain).alias("src_chain"), F.col("n").alias("src_events"))
    d = leg(dest, "dest").select(
        F.col(key).alias("d_id"), F.col(ts).alias("dest_evt_time"),
        F.col(chain).alias("dest_chain"), F.col("n").alias("dest_events"))
    j = s.join(d, s["s_id"] == d["d_id"], "full_outer")
    cols = [F.coalesce("s_id", "d_id").alias("orderid"), "src_evt_time", "src_chain",
            "dest_evt_time", "dest_chain"]
    if with_counts:
        cols += [F.coalesce("src_events", F.lit(0)).alias("src_events"),
                 F.coalesce("dest_events", F.lit(0)).alias("dest_events")]
    return j.select(*cols)


def backlog(candidates: DataFrame, processed: DataFrame, key: str,
            processed_key: str | None = None) -> DataFrame:
    """Candidates whose id is not stored yet.

    A NULL candidate id is kept (no stored id can equal it), as a pandas
    ``~isin`` does when the stored ids hold no NULL. Stored ids may repeat: an
    anti join needs no distinct ones, and an aggregate before it would keep
    AQE from splitting a hot candidate id.
    """
    pk = processed_key or key
    done = processed.select(F.col(pk).alias("__done"))
    return candidates.join(done, candidates[key] == done["__done"], "left_anti")


#: Words of 64 bits in a filter of ids (2 MB), and how many of them a row holds while they are put together.
FILTER_WORDS, WORDS_A_ROW = 1 << 18, 1 << 9
#: Types whose equal values have equal hashes.
FILTERED = {"string", "bigint", "int"}


def not_stored(ids: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The distinct ``ids`` of a batch that are not among the ``stored`` ones (J3 for batches).

    Stored ids that a filter of the batch's ids (``id_filter``) rules out are dropped where they are read, so the
    shuffle grows with the batch and not with the table. The others are probed against a hash table of the
    batch's ids, partition by partition, and not sorted; only those found go on to the anti join. Nothing is
    cached: a cached plan keeps all shuffle partitions, which costs a small batch more than reading it again.
    """
    kinds = {dict(df.dtypes).get(key) for df in (ids, stored)}
    if len(kinds) == 1 and kinds <= FILTERED:          # ids of two types are compared by a cast, their hashes differ
        stored = stored.where(_in_filter(id_filter(ids, key).scalar(), key))
    hits = stored.join(ids.hint("shuffle_hash"), key, "left_semi")
    return ids.join(hits.hint("shuffle_hash"), key, "left_anti")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def _place(key: str) -> Column:
    """The bit of an id in a filter."""
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(64 * FILTER_WORDS))


def id_filter(ids: DataFrame, key: str) -> DataFrame:
    """The bits of the hashes of ``ids``: one row, ``bits`` an array of 64-bit words. It is of one size for any
    batch: the more ids, the fewer others it rules out (of 2 million ids, 11 % of the others pass)."""
    bits = ids.select(_place(key).alias("place")).select(F.shiftright("place", 6).alias("word"), _bit(F.col("place")).alias("bits"))
    unset = ids.sparkSession.range(FILTER_WORDS).selectExpr("id AS word", "0L AS bits")
    # dealt by the row they end in: nearly every id sets a word of its own, so summing up before would save nothing
    rows = bits.unionByName(unset).withColumn("row", F.floor(F.col("word") / WORDS_A_ROW)).repartition("row")

    def in_order(number: str, value: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(number, value))), lambda x: x[value])

    words = rows.groupBy("row", "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy("row").agg(in_order("word", "bits").alias("bits")).agg(F.flatten(in_order("row", "bits")).alias("bits"))


def _in_filter(bits: Column, key: str) -> Column:
    """False for ids that are surely not in the filter. The condition that always holds keeps Spark from inferring
    the filter for the other side of a join too, where it rules out nothing and has the ids read once more."""
    place = _place(key)
    word = F.when(F.monotonically_increasing_id() >= 0, F.get(bits, F.shiftright(place, 6).cast("int")))
    return word.bitwiseAND(_bit(place)) != 0


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """``SELECT DISTINCT key``."""
    return df.select(key).distinct()
