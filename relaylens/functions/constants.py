"""Fixed values that must equal the analysed workflows' own constants.

FIXED VALUES — do not edit; results depend on them exactly.
"""

# Text sentinels a flattened, stringified document uses for "no value":
# a missing key is written as 'nan', an explicit null as 'None'.
MISSING_TEXT = ("nan", "None", "")

# Texts that a CSV export uses for "no value" (the defaults of the common readers).
CSV_MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Hourly event packing: chain value in the event table -> packed column name.
PACK_CHAINS = (
    ("ethereum", "ETH"),
    ("bnb", "BSC"),
    ("arbitrum", "ARB"),
    ("avalanche_c", "AVAX"),
    ("polygon", "POL"),
    ("linea", "LIN"),
    ("base", "BASE"),
    ("optimism", "OP"),
)

# Separators of the packed event cells: items, then "<id>-<time>".
PACK_ITEM_SEP = ", "
PACK_FIELD_SEP = "-"

# USD reference price by LIKE pattern on the output leg of a pair label;
# the first matching rule wins, anything else is priced 0.
USD_PRICE_LADDER = (
    ("%SOL%", 150.0),
    ("%ETH%", 2400.0),
    ("%Eth%", 2400.0),
    ("BNB", 500.0),
    ("%USD%", 1.0),
)
USD_PRICE_DEFAULT = 0.0

# Chain classification overrides for order legs.
EVM_ADDRESS_PREFIX = "0x"
NON_EVM_CHAIN = "SOL"
SONIC_SYMBOL = "S"
SONIC_SYMBOL_PREFIX = "sc"
SONIC_CHAIN = "SONIC"

# Bridge chain id -> chain name (36 entries); unknown ids map to "Unknown".
CHAIN_CODES = {
    1: "Solana", 2: "Ethereum", 4: "BNB Smart Chain",
    5: "Polygon", 6: "Avalanche", 7: "Oasis",
    8: "Algorand", 10: "Fantom", 11: "Karura",
    12: "Acala", 13: "Klaytn", 14: "Celo",
    15: "NEAR", 16: "Moonbeam", 17: "Neon",
    18: "Terra 2", 19: "Injective", 20: "Osmosis",
    22: "Aptos", 23: "Arbitrum", 24: "Optimism",
    25: "Gnosis", 26: "Sui", 28: "PythNet",
    29: "XPLA", 30: "Base", 32: "Sei",
    3104: "Wormchain", 10002: "Sepolia Testnet", 10004: "BSC Testnet",
    10005: "Mumbai Testnet", 10006: "Fuji Testnet", 10010: "Fantom Testnet",
    10016: "Moonbase Alpha Testnet", 10023: "Arbitrum Goerli", 10024: "Optimism Goerli",
}
UNKNOWN_CHAIN = "Unknown"

# Timestamp text of fill exports, e.g. "2024-11-02 10:31:07.123456 UTC".
FILL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS z"
FILL_TIME_FORMAT_MILLIS = "yyyy-MM-dd HH:mm:ss.SSS z"

# Successful transfer status of the aggregator feed.
DONE_STATUS = "DONE"

# Flattening: a nested object holding this key collapses to its value.
STRING_VALUE_KEY = "stringValue"
# Column dropped from flattened order documents before storing.
RAW_METADATA_COLUMN = "orderMetadata_rawMetadataHex"

# Slice width of the bundle history walk and rows per stored order batch.
BUNDLE_SLICE = "5 minutes"
ORDER_BATCH_ROWS = 1000

# Columns left out of the flat bridge transfers (fixed values).
BRIDGE_DROP = [
    "emitterAddress", "id", "txHash", "originTx.attribute.value.originTxHash",
    "payload", "standardizedProperties", "globalTx", "originTx.txHash", "fromAddress",
    "fromChain", "normalizedDecimals", "originTx.attribute.value.originChainId", "feeAddress",
    "feeChain", "originTx.status", "originTx.attribute.type",
    "originTx.attribute.value.originAddress", "amount",
]
