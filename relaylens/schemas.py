"""Declared schemas of the landed datasets (FIXTURES F1–F12), as DDL.

Reading with a declared schema skips inference (one pass less over the
data) and makes drift visible instead of silently merged. Pass them to
``sources.files.read_csv`` / ``read_json_pages`` or to ``spark.read.schema``.
Dataset-specific fields beyond the ones the analyses use pass through when
reading with inference instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .functions import constants as K

# F1 packed hourly event export (CSV, one per side)
EVENTS_WIDE = "event_hour TIMESTAMP_NTZ, part INT, " + ", ".join(f"{n} STRING" for _, n in K.PACK_CHAINS)
# F2 raw event rows before packing
EVENT_SOURCE = "orderid STRING, evt_block_time TIMESTAMP_NTZ, chain STRING"
# F3 aligned legs
EVENT_LOG = "orderid STRING, src_evt_time STRING, src_chain STRING, dest_evt_time STRING, dest_chain STRING"
# F5 order documents (JSON lines), as nested as the feed sends them
_OFFER = ("STRUCT<finalAmount: STRUCT<stringValue: STRING>, metadata: STRUCT<decimals: STRING, symbol: STRING>, "
          "chainId: STRUCT<stringValue: STRING, bigIntegerValue: BIGINT>>")
_TOKEN = "STRUCT<name: STRING, symbol: STRING, decimals: STRING>"
_EVENT = "STRUCT<transactionHash: STRUCT<stringValue: STRING>>"
ORDER_DOC = ("orderId STRUCT<stringValue: STRING, bytesArrayValue: STRING>, makerSrc STRING, receiverDst STRING, "
             f"giveOfferWithMetadata {_OFFER}, takeOfferWithMetadata {_OFFER}, "
             f"createdSrcEventMetadata {_EVENT}, fulfilledDstEventMetadata {_EVENT}, "
             f"preswapData STRUCT<inAmount: STRING, outAmount: STRING, tokenInMetadata: {_TOKEN}, "
             f"tokenOutMetadata: {_TOKEN}>, "
             "taker STRING, percentFee STRING, finalPercentFee STRING, fixFee STRING, state STRING, "
             "orderMetadata STRUCT<origin: STRING, orderTradeType: STRING, rawMetadataHex: STRING>")
# F6 relayed transfers (CSV)
FILLS = ("input_time STRING, output_time STRING, token_symbol STRING, output_symbol STRING, "
         "output_token STRING, input_amount_usd DOUBLE, output_amount_usd DOUBLE, relayer STRING, "
         "src_chain STRING")
# F7 bridge transactions page (JSON, envelope `transactions`)
BRIDGE_TX_FIELDS = (
    ("id", "STRING"), ("txHash", "STRING"), ("emitterChain", "INT"), ("emitterAddress", "STRING"),
    ("tokenAmount", "STRING"), ("timestamp", "STRING"), ("payload", "STRING"),
    ("globalTx", "STRUCT<originTx: STRUCT<txHash: STRING, status: STRING, attribute: STRUCT<type: STRING, "
                 "value: STRUCT<originChainId: INT, originAddress: STRING, originTxHash: STRING>>>, "
                 "destinationTx: STRUCT<timestamp: STRING, chainId: INT>>"),
    ("standardizedProperties", "STRUCT<toChain: INT, tokenChain: INT, fromChain: INT, fromAddress: STRING, "
                               "feeAddress: STRING, feeChain: INT, amount: STRING, normalizedDecimals: INT>"),
)
BRIDGE_TX = ", ".join(f"{n} {t}" for n, t in BRIDGE_TX_FIELDS)
BRIDGE_PAGE = "transactions ARRAY<STRUCT<" + ", ".join(f"{n}: {t}" for n, t in BRIDGE_TX_FIELDS) + ">>"
# F8 chain-code dimension
CHAIN_DIM = "code INT, name STRING"
# F9 bundle pages (JSON, envelope `data`); other fields pass through
BUNDLE_PAGE = "data ARRAY<STRUCT<timestamp: BIGINT, tokens: ARRAY<STRING>, token_balance_delta: STRING>>"
# F10 transfer pages (JSON, envelope `transfers`)
TRANSFER_PAGE = ("transfers ARRAY<STRUCT<id: STRING, status: STRING, amount: DOUBLE, "
                 "sending: STRUCT<timestamp: BIGINT, chainId: BIGINT>>>")
# F11 price pages (JSON, envelope `Data`)
PRICE_PAGE = "Data ARRAY<STRUCT<TIMESTAMP: BIGINT, CLOSE: DOUBLE>>"
# F12 order-book page (bare JSON array)
ORDER_BOOK = "orderHash STRING, maker STRING, makerAmount STRING, makerRate DOUBLE"
# F13 file listing
INVENTORY = "key STRING, size BIGINT, last_modified TIMESTAMP"


def parse(ddl: str) -> T.StructType:
    """DDL text -> StructType."""
    return T.StructType.fromDDL(ddl)


ALL = {name: value for name, value in globals().items()
       if name.isupper() and not name.startswith("_") and isinstance(value, str)}
