"""Wire schemas and table columns."""

from __future__ import annotations

TRANSACTION = (
    "STRUCT<hash:STRING, transactionIndex:STRING, `from`:STRING, `to`:STRING, value:STRING, gas:STRING, gasPrice:STRING, input:STRING, type:STRING, maxPriorityFeePerGas:STRING, maxFeePerGas:STRING>"
)
BLOCK = f"STRUCT<number:STRING, timestamp:STRING, milliTimestamp:STRING, miner:STRING, transactions:ARRAY<{TRANSACTION}>>"
LOG = "STRUCT<address:STRING, topics:ARRAY<STRING>, data:STRING, transactionHash:STRING, transactionIndex:STRING, logIndex:STRING, removed:BOOLEAN>"
RECEIPT = f"STRUCT<transactionHash:STRING, transactionIndex:STRING, gasUsed:STRING, cumulativeGasUsed:STRING, effectiveGasPrice:STRING, contractAddress:STRING, status:STRING, logs:ARRAY<{LOG}>>"
TRACE = (
    "STRUCT<transactionHash:STRING, transactionPosition:STRING, action:STRUCT<`from`:STRING, `to`:STRING, value:STRING, init:STRING, input:STRING, creationMethod:STRING>, result:STRUCT<address:STRING, code:STRING>>"
)

#: JSON-RPC method of each body, in the order of the ids of a block's batch.
BLOCK_METHOD, RECEIPTS_METHOD, TRACES_METHOD = METHODS = ("eth_getBlockByNumber", "eth_getBlockReceipts", "trace_block")
RESULT = {BLOCK_METHOD: BLOCK, RECEIPTS_METHOD: f"ARRAY<{RECEIPT}>", TRACES_METHOD: f"ARRAY<{TRACE}>"}

#: Raw responses: one row for each block and method.
RAW = "block_num LONG, method STRING, body STRING, failed BOOLEAN"
#: The same as one row a block, in the order of the methods, with the milliseconds of the fetch it came with.
WIDE = "block_num LONG, block_body STRING, receipts_body STRING, traces_body STRING, any_failed BOOLEAN, fetch_ms DOUBLE"

#: Columns and types of the output tables.
TABLES = {
    "blocks": "chunk INT, number LONG, timestamp_s LONG, timestamp_ms LONG, miner STRING",
    "transactions": "chunk INT, block_number LONG, transaction_index INT, hash STRING, block_timestamp_s LONG, block_timestamp_ms LONG, method_id STRING, input STRING, from_address STRING, to_address STRING, value DECIMAL(38,0), gas_limit LONG, gas_price LONG, gas_used LONG, max_priority_fee_per_gas LONG, max_fee_per_gas LONG, cumulative_gas_used LONG, effective_gas_price LONG, contract_address STRING, status TINYINT, type TINYINT",
    "logs": "chunk INT, block_number LONG, transaction_index INT, log_index INT, block_timestamp_s LONG, block_timestamp_ms LONG, address STRING, data STRING, topic_zeroth STRING, topic_first STRING, topic_second STRING, topic_third STRING, rest_topics ARRAY<STRING>, transaction_hash STRING, removed BOOLEAN",
    "internal_transactions": "chunk INT, block_number LONG, block_timestamp_s LONG, block_timestamp_ms LONG, transaction_index INT, transaction_hash STRING, trace_index INT, from_address STRING, to_address STRING, value DECIMAL(38,0)",
    "contracts": "chunk INT, block_number LONG, transaction_index INT, transaction_hash STRING, trace_index INT, block_timestamp_s LONG, block_timestamp_ms LONG, address STRING, creation_method TINYINT, creator_address STRING, contract_factory STRING, creation_bytecode STRING, deployed_bytecode STRING",
    "contracts_by_addresses": "address STRING, creator STRING, tx_hash STRING, block_number LONG, timestamp LONG, contract_factory STRING, creation_bytecode STRING, deployed_bytecode STRING",
    "block_completions": "chunk INT, block_number LONG, tx_count INT, log_count INT, itx_count INT, contract_count INT",
}
#: Numbers of the six data tables in dumps.
DUMP_TABLES = ("blocks", "transactions", "logs", "internal_transactions", "contracts", "contracts_by_addresses")
