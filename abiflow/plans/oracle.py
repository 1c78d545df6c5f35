"""DuckDB oracles for the registered jobs.

Each oracle states the expected result from the source tables and the rules
the chain-shaped tables are built by (``sources/tpch_chain.py``,
``sources/tpch_payloads.py``): which orders are transactions to subscribed
contracts, which line items are logs carrying which event, which payloads
are cut.  None of them decodes a payload or hashes a signature, so they
check the Spark plan independently.
"""

from __future__ import annotations

from ..functions.abi_types import SCALAR_TYPES
from ..sources import tpch_chain as C
from ..sources.tpch_payloads import MIXED_KINDS
from .queries import TYPE_CHOICES

BN_ORDER = "datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"
BN_SHIP = "datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))"
# Fixed value: the shape of an event signature.
SHAPE = r"^(\w+)\(([^)]+)\)$"


def _addr(k: str) -> str:
    return f"lpad(lower(hex({k})), 40, '0')"


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in items) + "]"


SCALAR_NAMES = ", ".join(f"'{t}'" for t in SCALAR_TYPES)

CHAIN = f"""
WITH txs AS (
  SELECT {BN_ORDER} AS block_number, o_orderkey AS tx_index,
         sha256(CAST(o_orderkey AS VARCHAR)) AS tx_hash,
         CASE WHEN o_orderkey % 11 <> 0 THEN {_addr('o_custkey')} END AS to_addr,
         o_orderkey % 97 <> 0 AS has_receipt
  FROM orders),
subs AS (SELECT DISTINCT {_addr('c_custkey')} AS addr FROM customer WHERE c_custkey % 10 = 0),
sub_txs AS (SELECT t.* FROM txs t JOIN subs s ON t.to_addr = s.addr),
gaps AS (SELECT block_number, min(tx_index) AS gap FROM sub_txs WHERE NOT has_receipt GROUP BY block_number),
kept AS (SELECT t.* FROM sub_txs t LEFT JOIN gaps g ON t.block_number = g.block_number
         WHERE g.gap IS NULL OR t.tx_index < g.gap),
li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS log_index
       FROM lineitem WHERE l_orderkey % 97 <> 0),
logs AS (SELECT k.block_number, k.tx_index, k.tx_hash, li.* FROM kept k JOIN li ON li.l_orderkey = k.tx_index),
matches AS (
  SELECT *, 0 AS event_ord, 'DummyStructCreated' AS event_name, '{C.CREATED_SIG}' AS signature
  FROM logs WHERE l_returnflag = 'A'
  UNION ALL
  SELECT *, 1 AS event_ord, 'DummyStructUpdated' AS event_name, '{C.UPDATED_SIG}' AS signature
  FROM logs WHERE l_returnflag = 'R' OR l_linestatus = 'F')
"""

KEYS = ("block_number AS arrival_seq, 0 AS arrival_pos, block_number, tx_index, tx_hash, log_index, "
        "event_ord, event_name")

# the seven-parameter event payload as hex text (see tpch_chain.event_payload)
EVENT_HEX = f"""(
  lpad(lower(hex(l_partkey)), 64, '0') || lpad(lower(hex(l_suppkey)), 64, '0') ||
  CASE WHEN l_linenumber - 4 < 0 THEN lpad(lower(hex(CAST(l_linenumber - 4 AS BIGINT))), 64, 'f')
       ELSE lpad(lower(hex(CAST(l_linenumber - 4 AS BIGINT))), 64, '0') END ||
  lpad(CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END, 64, '0') ||
  lpad({_addr('l_suppkey')}, 64, '0') || lpad('e0', 64, '0') ||
  sha256(CAST(l_partkey AS VARCHAR)) ||
  lpad(lower(hex(octet_length(encode(l_returnflag)))), 64, '0') ||
  rpad(lower(hex(l_returnflag)), CAST(ceil(octet_length(encode(l_returnflag)) / 32) * 64 AS INTEGER), '0'))"""

K1 = CHAIN + f"""
SELECT {KEYS},
  CAST(l_partkey AS DECIMAL(20,0)) AS p0, CAST(l_suppkey AS DECIMAL(20,0)) AS p1,
  CAST(l_linenumber - 4 AS BIGINT) AS p2, l_linestatus = 'F' AS p3, {_addr('l_suppkey')} AS p4,
  l_returnflag AS p5, sha256(CAST(l_partkey AS VARCHAR)) AS p6
FROM matches WHERE l_partkey % 13 <> 0
"""

# the same rows keyed by polled batches: four consecutive block numbers per
# announcement, positions in block order among the blocks that exist
K1_HASH = CHAIN + f""",
bpos AS (
  SELECT block_number,
         CAST(row_number() OVER (PARTITION BY block_number // 4 ORDER BY block_number) - 1 AS INTEGER) AS pos
  FROM (SELECT DISTINCT {BN_ORDER} AS block_number FROM orders))
SELECT block_number // 4 AS arrival_seq, pos AS arrival_pos, block_number, tx_index, tx_hash, log_index,
  event_ord, event_name,
  CAST(l_partkey AS DECIMAL(20,0)) AS p0, CAST(l_suppkey AS DECIMAL(20,0)) AS p1,
  CAST(l_linenumber - 4 AS BIGINT) AS p2, l_linestatus = 'F' AS p3, {_addr('l_suppkey')} AS p4,
  l_returnflag AS p5, sha256(CAST(l_partkey AS VARCHAR)) AS p6
FROM matches JOIN bpos USING (block_number) WHERE l_partkey % 13 <> 0
"""

# VARIANT params rendered by to_json: keys in order, binary as base64
D16 = CHAIN + f"""
SELECT {KEYS},
  CASE WHEN l_partkey % 13 = 0 THEN 'OutOfBounds' END AS error,
  CASE WHEN l_partkey % 13 <> 0 THEN
    '{{"p0":' || CAST(l_partkey AS VARCHAR) || ',"p1":' || CAST(l_suppkey AS VARCHAR) ||
    ',"p2":' || CAST(l_linenumber - 4 AS VARCHAR) ||
    ',"p3":' || CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END ||
    ',"p4":"' || {_addr('l_suppkey')} || '","p5":"' || l_returnflag ||
    '","p6":"' || to_base64(unhex(sha256(CAST(l_partkey AS VARCHAR)))) || '"}}'
  END AS params_json
FROM matches
"""

O3 = f"""
SELECT *, CASE WHEN error IS NULL THEN 'decoded' ELSE 'failed' END AS status FROM ({D16})
"""

K2 = CHAIN + f"""
SELECT {KEYS}, 'OutOfBounds' AS error, left({EVENT_HEX}, 200) AS data_hex
FROM matches WHERE l_partkey % 13 = 0
"""

K3 = CHAIN + f"""
SELECT {KEYS}, signature FROM matches
"""

K4 = CHAIN + """
SELECT block_number AS arrival_seq, 0 AS arrival_pos, block_number, tx_index, tx_hash,
       'ReceiptNotFound: ' || tx_hash AS error
FROM sub_txs WHERE NOT has_receipt
QUALIFY row_number() OVER (PARTITION BY block_number ORDER BY tx_index) = 1
"""

J1 = f"""
SELECT {_addr('c_custkey')} AS contract_address, c_custkey AS subscription_ord,
       '{C.CREATED_SIG};{C.UPDATED_SIG}' AS events_text
FROM customer WHERE c_custkey % 10 = 0
"""

LOOKUP_NUMBER = f"""
WITH blocks AS (SELECT DISTINCT {BN_ORDER} AS block_number FROM orders),
ann AS (SELECT DISTINCT {BN_SHIP} AS block_number FROM lineitem),
looked AS (
  SELECT a.block_number AS arrival_seq, 0 AS arrival_pos, a.block_number,
         CASE WHEN b.block_number IS NOT NULL THEN sha256('block:' || CAST(a.block_number AS VARCHAR)) END AS block_hash
  FROM ann a LEFT JOIN blocks b ON a.block_number = b.block_number),
cut AS (SELECT min(arrival_seq) AS first_missing FROM looked WHERE block_hash IS NULL)
"""

A4 = LOOKUP_NUMBER + """
SELECT arrival_seq, arrival_pos, block_number, block_hash FROM looked CROSS JOIN cut
WHERE block_hash IS NOT NULL AND (first_missing IS NULL OR arrival_seq < first_missing)
"""

A6_NUMBER = LOOKUP_NUMBER + """
SELECT arrival_seq, arrival_pos, block_number, 'BlockNotFoundForNumber: ' || CAST(block_number AS VARCHAR) AS error
FROM looked CROSS JOIN cut WHERE arrival_seq = first_missing
"""

K5 = LOOKUP_NUMBER + """
SELECT arrival_seq, arrival_pos, block_number FROM looked CROSS JOIN cut
WHERE first_missing IS NULL OR arrival_seq <= first_missing
"""

LOOKUP_HASH = f"""
WITH blocks AS (SELECT DISTINCT {BN_ORDER} AS block_number FROM orders),
hb AS (SELECT block_number, sha256('block:' || CAST(block_number AS VARCHAR)) AS block_hash FROM blocks),
ann AS (SELECT DISTINCT {BN_SHIP} AS block_number FROM lineitem),
notes AS (
  SELECT block_number // 4 AS arrival_seq,
         CAST(row_number() OVER (PARTITION BY block_number // 4 ORDER BY block_number) - 1 AS INTEGER) AS arrival_pos,
         sha256('block:' || CAST(block_number AS VARCHAR)) AS block_hash
  FROM ann),
looked AS (SELECT n.arrival_seq, n.arrival_pos, hb.block_number, n.block_hash
           FROM notes n LEFT JOIN hb ON n.block_hash = hb.block_hash),
cut AS (SELECT arrival_seq AS ms, arrival_pos AS mp FROM looked WHERE block_number IS NULL
        ORDER BY arrival_seq, arrival_pos LIMIT 1)
"""

A5 = LOOKUP_HASH + """
SELECT l.arrival_seq, l.arrival_pos, l.block_number, l.block_hash
FROM looked l LEFT JOIN cut ON true
WHERE l.block_number IS NOT NULL
  AND (cut.ms IS NULL OR l.arrival_seq < cut.ms OR (l.arrival_seq = cut.ms AND l.arrival_pos < cut.mp))
"""

A6_HASH = LOOKUP_HASH + """
SELECT l.arrival_seq, l.arrival_pos, l.block_hash, 'BlockNotFound: ' || l.block_hash AS error
FROM looked l JOIN cut ON l.arrival_seq = cut.ms AND l.arrival_pos = cut.mp
"""


def _signature_errors(sig: str) -> str:
    """Projection list: shape test, trimmed types, first unsupported type,
    error text; over a relation with a ``{sig}`` column."""
    return f"""
    CASE WHEN {sig} IS NULL OR NOT regexp_matches({sig}, '{SHAPE}') THEN 'InvalidSignatureFormat'
         WHEN len(list_filter(list_transform(string_split(regexp_extract({sig}, '{SHAPE}', 2), ','), lambda x: trim(x)),
                  lambda x: regexp_replace(x, '(\\[\\])+$', '') NOT IN ({SCALAR_NAMES}))) > 0
         THEN 'UnsupportedDataType: ' || list_filter(
                  list_transform(string_split(regexp_extract({sig}, '{SHAPE}', 2), ','), lambda x: trim(x)),
                  lambda x: regexp_replace(x, '(\\[\\])+$', '') NOT IN ({SCALAR_NAMES}))[1]
    END"""


CATALOGUE = f"""
WITH s AS (
  SELECT p_partkey,
         split_part(p_name, ' ', 1) || '(' || {_sql_list(TYPE_CHOICES)}[CAST(p_partkey % {len(TYPE_CHOICES)} + 1 AS INTEGER)]
         || ',' || {_sql_list(TYPE_CHOICES)}[CAST(p_size % {len(TYPE_CHOICES)} + 1 AS INTEGER)] || ')'
         || CASE WHEN p_partkey % 50 = 0 THEN chr(10) ELSE '' END AS signature
  FROM part),
e AS (SELECT *, {_signature_errors('signature')} AS error FROM s)
SELECT p_partkey, signature, error IS NULL AS is_valid, error,
  CASE WHEN error IS NULL THEN regexp_extract(signature, '{SHAPE}', 1) END AS event_name,
  CASE WHEN error IS NULL THEN array_to_string(list_transform(
      list_transform(string_split(regexp_extract(signature, '{SHAPE}', 2), ','), lambda x: trim(x)),
      lambda x: CASE regexp_replace(x, '(\\[\\])+$', '') WHEN 'uint' THEN 'uint256' WHEN 'int' THEN 'int256'
                ELSE regexp_replace(x, '(\\[\\])+$', '') END || regexp_extract(x, '((\\[\\])*)$', 1)), ',') END AS type_key
FROM e
"""

A8 = f"""
WITH raw AS (
  SELECT c_custkey AS subscription_ord, c_custkey % 7 AS r, lpad(hex(c_custkey), 40, '0') AS hex40 FROM customer),
cfg AS (
  SELECT subscription_ord,
    CASE WHEN r = 1 THEN '0xzz' || substr(hex40, 3, 38) WHEN r = 2 THEN '0x' || substr(hex40, 2, 39)
         WHEN r = 4 THEN NULL WHEN r = 6 THEN hex40 ELSE '0x' || hex40 END AS addr,
    CASE WHEN r = 3 THEN NULL WHEN r = 5 THEN ['{C.CREATED_SIG}', 'Broken(uint24)']
         ELSE ['{C.CREATED_SIG}', '{C.UPDATED_SIG}'] END AS events
  FROM raw),
ev AS (SELECT subscription_ord, unnest(events) AS signature, generate_subscripts(events, 1) - 1 AS event_ord
       FROM cfg WHERE events IS NOT NULL),
bad AS (SELECT subscription_ord, arg_min(signature || ': ' || error, event_ord) AS event_error
        FROM (SELECT *, {_signature_errors('signature')} AS error FROM ev) WHERE error IS NOT NULL
        GROUP BY subscription_ord),
v AS (
  SELECT c.subscription_ord,
    CASE WHEN regexp_matches(addr, '^(0x)?[0-9a-fA-F]{{40}}$') THEN lower(regexp_replace(addr, '^0x', '')) END AS contract_address,
    CASE WHEN addr IS NULL THEN 'MissingField: contract_address'
         WHEN events IS NULL THEN 'MissingField: events'
         WHEN NOT regexp_matches(addr, '^(0x)?[0-9a-fA-F]{{40}}$') THEN 'InvalidAddress: ' || addr
         WHEN b.event_error IS NOT NULL THEN 'InvalidEvent: ' || b.event_error END AS error
  FROM cfg c LEFT JOIN bad b ON c.subscription_ord = b.subscription_ord)
SELECT subscription_ord, contract_address, error IS NULL AS is_valid, error FROM v
"""

D_SCALAR = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(l_orderkey AS DECIMAL(20,0)) AS p0, CAST(l_linenumber + 250 AS DECIMAL(20,0)) AS p1,
  -l_partkey AS p2, l_suppkey - 50 AS p3, l_returnflag = 'R' AS p4, {_addr('l_partkey')} AS p5,
  left(sha256(CAST(l_partkey AS VARCHAR)), 8) AS p6, left(sha256(CAST(l_suppkey AS VARCHAR)), 32) AS p7,
  CAST(l_orderkey * 1000003 AS DECIMAL(20,0)) AS p8, CAST(NULL AS VARCHAR) AS error
FROM lineitem
"""

D5 = """
SELECT doc_id, text AS p0, sha256(text) AS p1_sha256, octet_length(encode(text)) AS p1_len,
  CAST(doc_id AS DECIMAL(20,0)) AS p2, CAST(NULL AS VARCHAR) AS error
FROM documents
"""

D8 = """
SELECT l_orderkey,
  CAST(row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS pos,
  CAST(l_partkey AS DECIMAL(20,0)) AS part, l_returnflag || l_linestatus AS flag, CAST(NULL AS VARCHAR) AS error
FROM lineitem
"""

D9 = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey AS DECIMAL(20,0)) AS f0,
  l_returnflag = 'R' AS f1, {_addr('l_suppkey')} AS f2, CAST(l_linenumber - 4 AS BIGINT) AS p1,
  CAST(NULL AS VARCHAR) AS error
FROM lineitem
"""

D15 = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_partkey % 6 = 0 THEN CAST(l_partkey AS DECIMAL(20,0)) END AS p0,
  CASE WHEN l_partkey % 6 = 0 THEN l_returnflag END AS p1,
  CASE WHEN l_partkey % 6 = 0 THEN l_linestatus = 'F' END AS p2,
  CASE l_partkey % 6 WHEN 1 THEN 'OutOfBounds' WHEN 2 THEN 'InvalidUnsignedInteger' WHEN 3 THEN 'Utf8Error'
                     WHEN 4 THEN 'IntegerOverflow' WHEN 5 THEN 'OutOfBounds' END AS error
FROM lineitem
"""

K5_HASH = f"""
SELECT arrival_seq, arrival_pos, block_number FROM ({A5})
"""

U1 = CHAIN + """
SELECT block_number AS arrival_seq, 0 AS arrival_pos, block_number, sha256('block:' || CAST(block_number AS VARCHAR)) AS block_hash,
  CAST(row_number() OVER (PARTITION BY block_number ORDER BY tx_index) - 1 AS INTEGER) AS place, tx_index, tx_hash, to_addr AS to_address
FROM txs
"""

U2 = CHAIN + f"""
SELECT {KEYS}, CAST(CASE WHEN l_partkey % 13 = 0 THEN 100 ELSE length({EVENT_HEX}) // 2 END AS BIGINT) AS data_len
FROM matches
"""

# transaction indices are positions in the block, not order keys
A9 = CHAIN + f""",
places AS (SELECT tx_index AS o_key, row_number() OVER (PARTITION BY block_number ORDER BY tx_index) - 1 AS place FROM txs)
SELECT block_number AS arrival_seq, 0 AS arrival_pos, block_number, place AS tx_index, tx_hash, log_index,
  event_ord, event_name, signature
FROM matches JOIN places ON o_key = tx_index
"""

A11 = f"""
WITH li AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS log_index
  FROM lineitem WHERE l_orderkey % 97 <> 0),
logs AS (
  SELECT sha256(CAST(l_orderkey AS VARCHAR)) AS tx_hash, log_index, {_addr('l_suppkey')} AS address,
    CASE l_returnflag WHEN 'A' THEN '{C.CREATED_HASH}' WHEN 'R' THEN '{C.UPDATED_HASH}' ELSE '{C.TRANSFER_HASH}' END
      || CASE WHEN l_linestatus = 'F' THEN ',{C.UPDATED_HASH}' ELSE '' END AS topics,
    CASE WHEN l_partkey % 13 = 0 THEN left({EVENT_HEX}, 200) ELSE {EVENT_HEX} END AS data_hex, l_orderkey
  FROM li JOIN (SELECT DISTINCT o_orderkey FROM orders) ON o_orderkey = l_orderkey)
SELECT tx_hash, log_index, address, topics, data_hex FROM logs
UNION ALL
SELECT tx_hash, log_index, address, topics, data_hex FROM logs WHERE l_orderkey % 5 = 0
"""

D16_MIXED = f"""
WITH v AS (
  SELECT *, [
    CAST(l_partkey AS VARCHAR),
    CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END,
    CAST(l_linenumber - 4 AS VARCHAR),
    '"' || l_returnflag || l_linestatus || '"',
    '[' || l_partkey || ',' || l_suppkey || ']',
    '[[' || l_partkey || '],[' || l_suppkey || ',' || l_linenumber || ']]',
    '["' || to_base64(encode(l_returnflag)) || '","' || to_base64(encode(l_linestatus)) || '"]',
    '{{"f0":' || l_suppkey || ',"f1":["' || l_returnflag || '"]}}'] AS j,
    {_sql_list(MIXED_KINDS)} AS t,
    CAST(l_partkey % 8 + 1 AS INTEGER) AS a, CAST(l_suppkey % 8 + 1 AS INTEGER) AS b
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, t[a] || ',' || t[b] AS type_key, CAST(NULL AS VARCHAR) AS error,
  '{{"p0":' || j[a] || ',"p1":' || j[b] || '}}' AS params_json
FROM v
"""

# Keccak-f[1600], fixed values: rotation of lane x + 5y, and the constant of each round.
KECCAK_ROTATIONS = [
    0, 1, 62, 28, 27, 36, 44, 6, 55, 20, 3, 10, 43, 25, 39, 41, 45, 15, 21, 8, 18, 2, 61, 56, 14,
]
KECCAK_ROUNDS = [
    0x0000000000000001, 0x0000000000008082, 0x800000000000808A, 0x8000000080008000,
    0x000000000000808B, 0x0000000080000001, 0x8000000080008081, 0x8000000000008009,
    0x000000000000008A, 0x0000000000000088, 0x0000000080008009, 0x000000008000000A,
    0x000000008000808B, 0x800000000000008B, 0x8000000000008089, 0x8000000000008003,
    0x8000000000008002, 0x8000000000000080, 0x000000000000800A, 0x800000008000000A,
    0x8000000080008081, 0x8000000000008080, 0x0000000080000001, 0x8000000080008008,
]
ONES = "18446744073709551615::UBIGINT"


def _rotated(lane: str, by: int) -> str:
    """A lane turned left; the bits that leave are masked off first, since
    the shift refuses to overflow."""
    if by == 0:
        return lane
    return f"((({lane}) & {(1 << (64 - by)) - 1}::UBIGINT) << {by}::UBIGINT) | (({lane}) >> {64 - by}::UBIGINT)"


def _keccak_round() -> list[str]:
    """Column lists of the three steps of a round over lanes a0 .. a24."""
    column = [f"xor(xor(xor(xor(a{x}, a{x + 5}), a{x + 10}), a{x + 15}), a{x + 20}) AS c{x}" for x in range(5)]
    mixed = [f"xor(c{(x + 4) % 5}, {_rotated(f'c{(x + 1) % 5}', 1)}) AS d{x}" for x in range(5)]
    moved = []
    for x in range(5):
        for y in range(5):
            lane = f"xor(a{x + 5 * y}, d{x})"
            moved.append(f"{_rotated(lane, KECCAK_ROTATIONS[x + 5 * y])} AS b{y + 5 * ((2 * x + 3 * y) % 5)}")
    out = []
    for y in range(5):
        for x in range(5):
            row = [f"b{(x + k) % 5 + 5 * y}" for k in range(3)]
            lane = f"xor({row[0]}, xor({row[1]}, {ONES}) & {row[2]})"
            out.append(f"xor({lane}, rc[r + 1])" if x == y == 0 else lane)
    return [", ".join(column), ", ".join(mixed), ", ".join(moved), ", ".join(f"{e} AS a{i}" for i, e in enumerate(out))]


def _turned(i: int) -> str:
    """Lane i of the padded message: its eight bytes, the last one first."""
    byte = ", ".join(f"substr(m, {16 * i + 2 * k + 1}, 2)" for k in range(7, -1, -1))
    return f"CAST(concat('0x', {byte}) AS UBIGINT)"


_C, _D, _B, _A = _keccak_round()
_LANES = ", ".join(f"a{i}" for i in range(25))

# one block of 136 bytes: the signatures of the job are far shorter
G8 = f"""
WITH RECURSIVE sig AS (SELECT DISTINCT signature FROM ({CATALOGUE}) WHERE is_valid),
padded AS (SELECT signature, rpad(lower(hex(encode(signature))) || '01', 270, '0') || '80' AS m FROM sig),
k AS (
  SELECT signature, 0 AS r, {", ".join(f"{_turned(i) if i < 17 else '0::UBIGINT'} AS a{i}" for i in range(25))}
  FROM padded
  UNION ALL
  SELECT signature, r + 1 AS r, {_A}
  FROM (SELECT signature, r, {_B} FROM (SELECT *, {_D} FROM (SELECT *, {_C} FROM k WHERE r < 24))),
       (SELECT [{", ".join(f"{c}::UBIGINT" for c in KECCAK_ROUNDS)}] AS rc)),
hashes AS (
  SELECT signature, lower(array_to_string(list_transform([a0, a1, a2, a3], lambda v: array_to_string(
      list_transform(range(0, 8), lambda i: lpad(hex((v >> (8 * i)::UBIGINT) & 255::UBIGINT), 2, '0')), '')), '')) AS hash
  FROM k WHERE r = 24)
SELECT c.p_partkey, c.signature, h.hash FROM ({CATALOGUE}) c JOIN hashes h ON h.signature = c.signature WHERE c.is_valid
"""

ORACLE_SQL: dict[str, str] = {
    "k1_decoded_events": K1,
    "o2_stream_decoded": K1,
    "o2_stream_by_hash": K1_HASH,
    "k2_dead_letters": K2,
    "d16_variant_events": D16,
    "o3_batch_run_tables": O3,
    "a10_receipts_filed_elsewhere": K1,
    "j3_rows_landed_twice": K1,
    "o3_replayed_events": O3,
    "k4_replayed_receipt_gaps": K4,
    "k3_match_notices": K3,
    "j4_match_by_explode": K3,
    "k4_receipt_gaps": K4,
    "j1_first_subscription": J1,
    "a4_block_lookup_by_number": A4,
    "a6_missing_block_by_number": A6_NUMBER,
    "k5_progress_by_number": K5,
    "a5_block_lookup_by_hash": A5,
    "a6_missing_block_by_hash": A6_HASH,
    "k5_progress_by_hash": K5_HASH,
    "u1_block_consumer": U1,
    "u2_match_consumer": U2,
    "a9_nested_blocks": A9,
    "a11_nested_receipts": A11,
    "d16_mixed_types": D16_MIXED,
    "g_signature_catalogue": CATALOGUE,
    "g8_event_hash": G8,
    "a8_subscription_validation": A8,
    "d_scalar_roundtrip": D_SCALAR,
    "d5_string_roundtrip": D5,
    "d8_array_roundtrip": D8,
    "d9_struct_roundtrip": D9,
    "d15_decode_errors": D15,
}
