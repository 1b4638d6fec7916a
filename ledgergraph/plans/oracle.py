"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle re-derives the ledger from ``orders``/``lineitem`` with plain window functions
(``row_number``/``lead``/``lag``) — the straightforward single-node formulation the Spark plans
avoid — and then computes the query.

DuckDB has no RIPEMD-160, so the oracle computes hash160 of P2PK public keys itself:
SHA-256 (built in) followed by RIPEMD-160 of the 32-byte digest — a single 64-byte block —
as an 80-step recursive CTE over 32-bit words, with the specification's constants taken from
``functions.hashing``. It is checked against ``hashlib`` in the tests.
"""

from __future__ import annotations

from ledgergraph.functions.hashing import (B58_ALPHABET, RMD_H0, RMD_K1, RMD_K2, RMD_R1, RMD_R2,
                                           RMD_S1, RMD_S2)

_MASK32 = "4294967295"


def _rmd_f(jexpr: str, x: str, y: str, z: str) -> str:
    """The five RIPEMD-160 boolean functions, chosen by step number (SQL on 32-bit words)."""
    nx, ny, nz = (f"(~{v} & {_MASK32})" for v in (x, y, z))
    return (f"(CASE WHEN {jexpr} < 16 THEN xor(xor({x}, {y}), {z}) "
            f"WHEN {jexpr} < 32 THEN (({x} & {y}) | ({nx} & {z})) "
            f"WHEN {jexpr} < 48 THEN xor(({x} | {ny}), {z}) "
            f"WHEN {jexpr} < 64 THEN (({x} & {z}) | ({y} & {nz})) "
            f"ELSE xor({x}, ({y} | {nz})) END)")


def _rol(v: str, s: str) -> str:
    return f"((({v}) << ({s})) | (({v}) >> (32 - ({s})))) & {_MASK32}"


def hash160_ctes(src: str, col: str) -> str:
    """CTEs ending in ``hash160(k, h160)``: upper-hex hash160 of the hex keys ``src.col``.

    RIPEMD-160 runs on the 32-byte SHA-256 digest: one padded 64-byte block whose 16
    little-endian words are the digest's 8 words, 0x80, zeros and the bit length 256.
    """
    steps = ", ".join(
        f"({j}, {RMD_R1[j]}, {RMD_S1[j]}, {RMD_K1[j // 16]}, {RMD_R2[j]}, {RMD_S2[j]}, {RMD_K2[j // 16]})"
        for j in range(80))

    def word(i: int) -> str:   # little-endian word i of the digest (hex text d)
        b = [f"substr(d, {8 * i + 2 * k + 1}, 2)" for k in range(4)]
        return f"CAST('0x' || {b[3]} || {b[2]} || {b[1]} || {b[0]} AS BIGINT)"

    block = "[" + ", ".join([word(i) for i in range(8)] + ["128", "0", "0", "0", "0", "0", "256", "0"]) + "]"
    h = RMD_H0
    start = ", ".join(f"CAST({v} AS BIGINT)" for v in list(h) + list(h))
    left = f"((r.al + {_rmd_f('r.j', 'r.bl', 'r.cl', 'r.dl')} + r.x[c.r1 + 1] + c.k1) & {_MASK32})"
    right = f"((r.ar + {_rmd_f('79 - r.j', 'r.br', 'r.cr', 'r.dr')} + r.x[c.r2 + 1] + c.k2) & {_MASK32})"
    hexed = " || ".join(
        f"printf('%02X%02X%02X%02X', (h{i} & 255), ((h{i} >> 8) & 255), ((h{i} >> 16) & 255), ((h{i} >> 24) & 255))"
        for i in range(5))
    return f"""
rmd_c(j, r1, s1, k1, r2, s2, k2) AS (VALUES {steps}),
rmd_x AS (SELECT {col} AS k, {block} AS x FROM (SELECT {col}, sha256(unhex({col})) AS d FROM {src})),
rmd(k, j, x, al, bl, cl, dl, el, ar, br, cr, dr, er) AS (
  SELECT k, 0, x, {start} FROM rmd_x
  UNION ALL
  SELECT k, j + 1, x,
         el, ((({_rol('tl', 's1')}) + el) & {_MASK32}), bl, ({_rol('cl', '10')}), dl,
         er, ((({_rol('tr', 's2')}) + er) & {_MASK32}), br, ({_rol('cr', '10')}), dr
  FROM (SELECT r.*, c.s1, c.s2, {left} AS tl, {right} AS tr
        FROM rmd r JOIN rmd_c c ON c.j = r.j WHERE r.j < 80)),
rmd_h AS (
  SELECT k, (({h[1]} + cl + dr) & {_MASK32}) AS h0, (({h[2]} + dl + er) & {_MASK32}) AS h1,
         (({h[3]} + el + ar) & {_MASK32}) AS h2, (({h[4]} + al + br) & {_MASK32}) AS h3,
         (({h[0]} + bl + cr) & {_MASK32}) AS h4
  FROM rmd WHERE j = 80),
hash160 AS (SELECT k, {hexed} AS h160 FROM rmd_h)"""


def base58check_ctes(src: str, col: str) -> str:
    """CTEs ending in ``b58(k, address)``: Base58Check (version 0x00) of the hex hash160 keys.

    The 25-byte payload (version, hash, 4-byte double-SHA-256 checksum) is held as five
    40-bit limbs; each recursive step divides it by 58 (long division across the limbs) and
    prepends the remainder's character; leading zero bytes become '1's.
    """
    limb = 1 << 40
    limbs = ", ".join(f"CAST('0x' || substr(p, {10 * i + 1}, 10) AS BIGINT) AS l{i}" for i in range(5))
    return f"""
b58_in AS (
  SELECT k, {limbs}, CAST(length(regexp_extract(p, '^(00)*', 0)) / 2 AS INTEGER) AS zeros
  FROM (SELECT k, v || substr(upper(sha256(unhex(sha256(unhex(v))))), 1, 8) AS p
        FROM (SELECT {col} AS k, '00' || {col} AS v FROM {src}))),
b58_div(k, l0, l1, l2, l3, l4, s) AS (
  SELECT k, l0, l1, l2, l3, l4, '' FROM b58_in
  UNION ALL
  SELECT k, q0, q1, q2, q3, c4 // 58, substr('{B58_ALPHABET}', CAST(c4 % 58 AS INTEGER) + 1, 1) || s FROM (
    SELECT *, (c3 % 58) * {limb} + l4 AS c4, c3 // 58 AS q3 FROM (
      SELECT *, (c2 % 58) * {limb} + l3 AS c3, c2 // 58 AS q2 FROM (
        SELECT *, (c1 % 58) * {limb} + l2 AS c2, c1 // 58 AS q1 FROM (
          SELECT *, (l0 % 58) * {limb} + l1 AS c1, l0 // 58 AS q0 FROM b58_div
          WHERE l0 <> 0 OR l1 <> 0 OR l2 <> 0 OR l3 <> 0 OR l4 <> 0))))),
b58 AS (
  SELECT d.k, repeat('1', i.zeros) || d.s AS address
  FROM b58_div d JOIN b58_in i ON i.k = d.k
  WHERE d.l0 = 0 AND d.l1 = 0 AND d.l2 = 0 AND d.l3 = 0 AND d.l4 = 0)"""


_KIND = """CASE
      WHEN script_hex IS NULL THEN 'unknown'
      WHEN script_hex = '' THEN 'anyone'
      WHEN length(script_hex) = 50 AND left(script_hex, 6) = '76A914' AND right(script_hex, 4) = '88AC' THEN 'p2pkh'
      WHEN length(script_hex) >= 4 AND right(script_hex, 2) = 'AC' THEN 'p2pk'
      WHEN length(script_hex) >= 6 AND left(script_hex, 2) = 'AA' AND right(script_hex, 2) = '87' THEN 'puzzle'
      WHEN left(script_hex, 2) = '6A' THEN 'unspendable'
      ELSE 'unknown' END"""

_ADDRESS = """CASE kind
      WHEN 'p2pkh' THEN substr(script_hex, 7, 40)
      WHEN 'p2pk' THEN (SELECT h160 FROM hash160 WHERE k = substr(script_hex, 3, length(script_hex) - 4))
      WHEN 'puzzle' THEN 'puzzle_' || substr(script_hex, 3, length(script_hex) - 6)
      WHEN 'anyone' THEN 'anyone'
      WHEN 'unspendable' THEN 'unspendable'
      ELSE 'unknown' END"""

LEDGER_CTES = f"""
days AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(min(epoch(o_orderdate)) AS INTEGER) AS time
  FROM orders GROUP BY 1),
blocks AS (
  SELECT upper(sha256('B' || day)) AS hash,
         coalesce(upper(sha256('B' || lag(day) OVER (ORDER BY day))), repeat('0', 64)) AS prev_hash,
         time
  FROM days),
transactions AS (
  SELECT upper(sha256('T' || o_orderkey)) AS hash,
         upper(sha256('B' || strftime(o_orderdate, '%Y-%m-%d'))) AS block_hash,
         CAST(epoch(o_orderdate) AS INTEGER) AS time
  FROM orders),
li AS (
  SELECT l_orderkey, l_partkey, l_returnflag, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS ord,
         upper(sha256('A' || l_partkey)) AS ha,
         upper(sha256('X' || l_partkey)) AS hx,
         upper(sha256('Y' || l_partkey)) AS hy
  FROM lineitem),
outputs_raw AS (
  SELECT upper(sha256('T' || l_orderkey)) AS tx_hash, ord,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS value,
         CASE WHEN l_partkey % 16 <= 9 THEN '76A914' || substr(ha, 1, 40) || '88AC'
              WHEN l_partkey % 16 <= 11 THEN '4104' || hx || hy || 'AC'
              WHEN l_partkey % 16 = 12 THEN 'AA20' || ha || '87'
              WHEN l_partkey % 16 = 13 THEN '6A04' || substr(ha, 1, 8) || '00'
              WHEN l_partkey % 16 = 14 THEN ''
              ELSE 'A914' || substr(ha, 1, 40) || '87' END AS script_hex,
         l_orderkey, l_returnflag
  FROM li),
outputs_k AS (SELECT *, {_KIND} AS kind FROM outputs_raw),
p2pk_keys AS (SELECT DISTINCT substr(script_hex, 3, length(script_hex) - 4) AS pubkey_hex
              FROM outputs_k WHERE kind = 'p2pk'),{hash160_ctes('p2pk_keys', 'pubkey_hex').rstrip()},
outputs AS (SELECT *, {_ADDRESS} AS address FROM outputs_k),
chain AS (
  SELECT o_orderkey,
         row_number() OVER w - 1 AS seq,
         lead(o_orderkey) OVER w AS next_orderkey
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
inputs AS (
  SELECT upper(sha256('T' || c.next_orderkey)) AS tx_hash, o.tx_hash AS ref_hash, o.ord AS ref_ord
  FROM outputs o JOIN chain c ON o.l_orderkey = c.o_orderkey
  WHERE c.next_orderkey IS NOT NULL AND o.l_returnflag <> 'N'
  UNION ALL
  SELECT upper(sha256('T' || o_orderkey)), repeat('0', 64), CAST(4294967295 AS BIGINT)
  FROM chain WHERE seq = 0),
spent AS (
  SELECT o.tx_hash, o.ord, o.value, o.address, i.tx_hash AS spent_by
  FROM outputs o LEFT JOIN inputs i ON o.tx_hash = i.ref_hash AND o.ord = i.ref_ord),
address_ids AS (
  SELECT row_number() OVER (ORDER BY address) - 1 AS id, address
  FROM (SELECT DISTINCT address FROM outputs)),
n_addr AS (SELECT count(*) AS n FROM address_ids),
block_ids AS (
  SELECT row_number() OVER (ORDER BY hash) - 1 + (SELECT n FROM n_addr) AS id, hash, time FROM blocks),
n_blk AS (SELECT count(*) AS n FROM blocks),
tx_ids AS (
  SELECT row_number() OVER (ORDER BY hash) - 1 + (SELECT n FROM n_addr) + (SELECT n FROM n_blk) AS id, hash
  FROM transactions),
n_in AS (SELECT tx_hash, count(*) AS n_in FROM inputs GROUP BY tx_hash),
pay_w AS (
  SELECT pa.id AS src, ra.id AS dst, CAST(sum(n.n_in) AS BIGINT) AS n
  FROM spent s
  JOIN n_in n ON n.tx_hash = s.tx_hash
  JOIN outputs o2 ON o2.tx_hash = s.spent_by
  JOIN address_ids pa ON pa.address = o2.address
  JOIN address_ids ra ON ra.address = s.address
  WHERE s.spent_by IS NOT NULL
  GROUP BY pa.id, ra.id)
"""


def with_ledger(body: str, recursive: bool = True) -> str:
    # the ledger CTEs contain the recursive hash160 computation, so every oracle recurses
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {LEDGER_CTES.strip()}\n{body}"


ORACLES: dict[str, str] = {
    "balances": with_ledger("""
SELECT address, CAST(sum(value) AS BIGINT) AS balance, count(*) AS n_utxo
FROM spent WHERE spent_by IS NULL GROUP BY address"""),
    "blocks": with_ledger("SELECT hash, prev_hash, time FROM blocks"),
    "transactions": with_ledger("SELECT hash, block_hash, time FROM transactions"),
    "outputs": with_ledger("SELECT tx_hash, ord, value, script_hex, address, kind FROM outputs"),
    "inputs": with_ledger("SELECT tx_hash, ref_hash, ref_ord FROM inputs"),
    "address_kind": with_ledger("SELECT DISTINCT address, kind FROM outputs"),
    "address_profile": with_ledger("""
SELECT kind, count(*) AS n_outputs, count(DISTINCT address) AS n_addresses FROM outputs GROUP BY kind"""),
    "addresses": with_ledger("SELECT DISTINCT address FROM outputs"),
    "spent_outputs": with_ledger("SELECT tx_hash, ord, value, address, spent_by FROM spent"),
    "utxo": with_ledger("SELECT tx_hash, ord, value, address FROM spent WHERE spent_by IS NULL"),
    "address_totals": with_ledger("""
, money AS (
  SELECT address, CAST(sum(value) AS BIGINT) AS total_received,
         CAST(coalesce(sum(CASE WHEN spent_by IS NOT NULL THEN value END), 0) AS BIGINT) AS total_sent
  FROM spent GROUP BY address),
txs AS (
  SELECT address, count(DISTINCT tx) AS n_tx FROM (
    SELECT address, tx_hash AS tx FROM spent
    UNION ALL SELECT address, spent_by FROM spent WHERE spent_by IS NOT NULL) GROUP BY address)
SELECT m.address, total_received, total_sent, total_received - total_sent AS final_balance, n_tx
FROM money m JOIN txs t ON m.address = t.address""".lstrip()),
    "first_seen": with_ledger("""
SELECT o.address, min(t.time) AS first_seen
FROM outputs o JOIN transactions t ON o.tx_hash = t.hash GROUP BY o.address"""),
    "tx_flat_size": with_ledger("""
, n_out AS (SELECT tx_hash, count(*) AS n_out FROM outputs GROUP BY tx_hash)
SELECT t.block_hash, CAST(sum(coalesce(i.n_in, 0) * coalesce(o.n_out, 0)) AS BIGINT) AS flat_size,
       count(*) AS n_tx
FROM transactions t LEFT JOIN n_out o ON o.tx_hash = t.hash LEFT JOIN n_in i ON i.tx_hash = t.hash
GROUP BY t.block_hash""".lstrip()),
}

# edges: four classes, documented direction
_EDGES_NAMED = """
, edges_named AS (
  SELECT block_hash AS src, hash AS dst, CAST(0 AS BIGINT) AS value, 'block_tx' AS edge_kind FROM transactions
  UNION ALL
  SELECT address, spent_by, value, 'address_tx' FROM spent WHERE spent_by IS NOT NULL
  UNION ALL
  SELECT tx_hash, address, value, 'tx_address' FROM outputs
  UNION ALL
  SELECT hash, prev_hash, CAST(0 AS BIGINT), 'block_prev' FROM blocks)
""".lstrip()

_EDGES_INDEXED = """
, edges_indexed AS (
  SELECT b.id AS src, t.id AS dst, CAST(0 AS BIGINT) AS value, 'block_tx' AS edge_kind
  FROM transactions tr JOIN block_ids b ON b.hash = tr.block_hash JOIN tx_ids t ON t.hash = tr.hash
  UNION ALL
  SELECT a.id, t.id, s.value, 'address_tx'
  FROM spent s JOIN address_ids a ON a.address = s.address JOIN tx_ids t ON t.hash = s.spent_by
  UNION ALL
  SELECT t.id, a.id, o.value, 'tx_address'
  FROM outputs o JOIN tx_ids t ON t.hash = o.tx_hash JOIN address_ids a ON a.address = o.address
  UNION ALL
  SELECT b.id, p.id, CAST(0 AS BIGINT), 'block_prev'
  FROM blocks bl JOIN block_ids b ON b.hash = bl.hash JOIN block_ids p ON p.hash = bl.prev_hash)
""".lstrip()

ORACLES.update({
    "edges_named": with_ledger(_EDGES_NAMED + "SELECT src, dst, value, edge_kind FROM edges_named"),
    "edge_counts": with_ledger(_EDGES_NAMED + "SELECT edge_kind, count(*) AS n FROM edges_named GROUP BY edge_kind"),
    "address_ids": with_ledger("SELECT id, address FROM address_ids"),
    "block_ids": with_ledger("SELECT id, hash, time FROM block_ids"),
    "tx_ids": with_ledger("SELECT id, hash FROM tx_ids"),
    "edges_indexed": with_ledger(_EDGES_INDEXED + "SELECT src, dst, value, edge_kind FROM edges_indexed"),
    "payment_edges_weighted": with_ledger("SELECT src, dst, n FROM pay_w"),
    "payment_edges": with_ledger("""
SELECT src, dst FROM pay_w, range(n) r"""),
})


_TOTALS = """
, money AS (
  SELECT address, CAST(sum(value) AS BIGINT) AS total_received,
         CAST(coalesce(sum(CASE WHEN spent_by IS NOT NULL THEN value END), 0) AS BIGINT) AS total_sent
  FROM spent GROUP BY address),
txs AS (
  SELECT address, count(DISTINCT tx) AS n_tx FROM (
    SELECT address, tx_hash AS tx FROM spent
    UNION ALL SELECT address, spent_by FROM spent WHERE spent_by IS NOT NULL) GROUP BY address),
totals AS (
  SELECT m.address, total_received, total_sent, total_received - total_sent AS final_balance, n_tx
  FROM money m JOIN txs t ON m.address = t.address)
""".lstrip()

# delta PageRank (reset 0.15, tol 0.001) as a recursive CTE carrying (rank, delta, active)
def _pagerank_ctes(edges: str, vertices: str, prefix: str = "") -> str:
    """Delta PageRank (reset 0.15, tol 0.001) as a recursive CTE carrying (rank, delta, active)
    over a weighted edge table ``edges(src, dst, n)`` and a vertex table ``vertices(id)``;
    ends in ``{prefix}ranks(id, rank)`` scaled to sum to the vertex count."""
    p = prefix
    return f"""
, {p}deg AS (SELECT src, sum(n) AS deg FROM {edges} GROUP BY src),
{p}ew AS (SELECT e.src, e.dst, e.n / d.deg AS wn FROM {edges} e JOIN {p}deg d ON e.src = d.src),
{p}pv AS (SELECT id FROM {vertices} UNION SELECT src FROM {edges} UNION SELECT dst FROM {edges}),
{p}pr(it, id, rank, delta, active, nmsg) AS (
  SELECT 0, id, CAST(0.15 AS DOUBLE), CAST(0.15 AS DOUBLE), true, CAST(1 AS BIGINT) FROM {p}pv
  UNION ALL
  SELECT s.it + 1, s.id,
         s.rank + coalesce(0.85 * m.msum, 0),
         coalesce(0.85 * m.msum, 0),
         m.msum IS NOT NULL,
         count(m.msum) OVER ()
  FROM {p}pr s LEFT JOIN (
      SELECT e.dst, sum(q.delta * e.wn) AS msum
      FROM {p}pr q JOIN {p}ew e ON e.src = q.id
      WHERE q.active AND q.delta > 0.001
      GROUP BY e.dst) m ON m.dst = s.id
  WHERE s.nmsg > 0),
{p}fin AS (SELECT id, rank FROM {p}pr WHERE it = (SELECT max(it) FROM {p}pr)),
{p}ranks AS (SELECT id, rank * (SELECT count(*) FROM {p}fin) / (SELECT sum(rank) FROM {p}fin) AS rank
             FROM {p}fin)
"""


_PAGERANK = _pagerank_ctes("pay_w", "address_ids").lstrip() + """,
top10 AS (
  SELECT a.address, round(r.rank, 6) AS rank FROM ranks r JOIN address_ids a ON a.id = r.id
  ORDER BY rank DESC, a.address LIMIT 10)
"""

# customer → supplier → part graph of the star tables (ids: kind × 10^9 + key)
_STAR_GRAPH = """
WITH RECURSIVE
li AS (SELECT o.o_custkey, l.l_suppkey, l.l_partkey
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
star_e AS (
  SELECT o_custkey AS src, 1000000000 + l_suppkey AS dst, count(*) AS n FROM li GROUP BY 1, 2
  UNION ALL
  SELECT 1000000000 + l_suppkey, 2000000000 + l_partkey, count(*) FROM li GROUP BY 1, 2),
star_v AS (
  SELECT c_custkey AS id FROM customer
  UNION SELECT 1000000000 + s_suppkey FROM supplier
  UNION SELECT 2000000000 + p_partkey FROM part)"""


_CHAIN = """
, chain_h(hash, height) AS (
  SELECT hash, CAST(0 AS BIGINT) FROM blocks WHERE prev_hash NOT IN (SELECT hash FROM blocks)
  UNION ALL
  SELECT b.hash, c.height + 1 FROM blocks b JOIN chain_h c ON b.prev_hash = c.hash)
""".lstrip()

_NEIGHBOURS = _TOTALS + """
, seed AS (
  SELECT a.id FROM (SELECT address FROM totals ORDER BY total_received DESC, address LIMIT 1) m
  JOIN address_ids a ON a.address = m.address),
nb AS (SELECT dst AS id FROM pay_w WHERE src IN (SELECT id FROM seed)
       UNION SELECT src FROM pay_w WHERE dst IN (SELECT id FROM seed)),
kept AS (SELECT id, 'seed' AS role FROM seed
         UNION ALL SELECT id, 'neighbour' FROM nb WHERE id NOT IN (SELECT id FROM seed))
"""


def _money(x: str) -> str:
    usd = f"(CAST({x} AS DOUBLE) / 1.0e8 * 4279.92)"
    return f"(CASE WHEN {usd} < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs({usd})))"


def _year(t: str) -> str:
    return f"CAST(year(CAST(epoch_ms(CAST({t} AS BIGINT) * 1000) AS DATE)) AS INTEGER)"


def _ts_text(t: str) -> str:
    return f"strftime(epoch_ms(CAST({t} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')"


ORACLES.update({
    "pagerank": with_ledger(_PAGERANK + """
SELECT r.id, a.address, round(r.rank, 6) AS rank FROM ranks r LEFT JOIN address_ids a ON a.id = r.id""",
                            recursive=True),
    "top_addresses": with_ledger(_PAGERANK + "SELECT address, rank FROM top10", recursive=True),
    "star_pagerank": _STAR_GRAPH + _pagerank_ctes("star_e", "star_v") + """
SELECT id, round(rank, 6) AS rank FROM ranks""",
    "graph_counts": with_ledger("""
, gv AS (SELECT id FROM address_ids UNION SELECT src FROM pay_w UNION SELECT dst FROM pay_w)
SELECT 'vertices' AS measure, count(*) AS n FROM gv
UNION ALL SELECT 'distinct_edges', count(*) FROM pay_w
UNION ALL SELECT 'edges', CAST(sum(n) AS BIGINT) FROM pay_w"""),
    "address_report": with_ledger(_PAGERANK + _TOTALS.replace("money AS", "money AS", 1) + f"""
SELECT t.address, t.rank, {_money('total_received')} AS received, {_money('total_sent')} AS sent,
       {_money('final_balance')} AS balance, n_tx AS transactions
FROM top10 t JOIN totals s ON s.address = t.address""", recursive=True),
    "usd_format": with_ledger(_TOTALS + f"""
SELECT address, CAST(final_balance AS DOUBLE) / 1.0e8 AS balance_btc,
       CAST(final_balance AS DOUBLE) / 1.0e8 * 4279.92 AS balance_usd,
       {_money('final_balance')} AS balance_text
FROM totals"""),
    "json_fields": """
SELECT event_id, user_id,
       CASE WHEN json_valid(props) THEN TRY_CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events""",
    "tx_text": with_ledger(f"""
SELECT hash, 'txId:    ' || hash || chr(10) || 'time:    ' || {_ts_text('time')} || chr(10)
       || 'block:   ' || block_hash || chr(10) AS text
FROM transactions"""),
    "chain_height": with_ledger(_CHAIN + "SELECT hash, height FROM chain_h", recursive=True),
    "block_listing": with_ledger(_CHAIN + "SELECT height, hash FROM chain_h", recursive=True),
    "block_drilldown": with_ledger(_CHAIN + """
, first_blocks AS (SELECT hash AS block_hash, height FROM chain_h WHERE height < 3),
dtx AS (SELECT t.block_hash, f.height, t.hash AS tx_hash, t.time
        FROM transactions t JOIN first_blocks f ON t.block_hash = f.block_hash),
vin AS (SELECT i.tx_hash, list({'ref_hash': i.ref_hash, 'ref_ord': i.ref_ord} ORDER BY i.ref_hash, i.ref_ord) AS vin
        FROM inputs i JOIN dtx d ON d.tx_hash = i.tx_hash GROUP BY i.tx_hash),
vout AS (SELECT o.tx_hash, list({'n': o.ord, 'value': o.value, 'address': o.address} ORDER BY o.ord, o.value, o.address) AS vout
         FROM outputs o JOIN dtx d ON d.tx_hash = o.tx_hash GROUP BY o.tx_hash)
SELECT d.block_hash, d.height, d.tx_hash,
       CAST(to_json({'txid': d.tx_hash, 'time': d.time,
                     'vin': coalesce(vin.vin, CAST([] AS STRUCT(ref_hash VARCHAR, ref_ord BIGINT)[])),
                     'vout': coalesce(vout.vout, CAST([] AS STRUCT(n BIGINT, value BIGINT, address VARCHAR)[]))})
            AS VARCHAR) AS tx_json
FROM dtx d LEFT JOIN vin ON vin.tx_hash = d.tx_hash LEFT JOIN vout ON vout.tx_hash = d.tx_hash""",
                                   recursive=True),
    "neighbourhood": with_ledger(_NEIGHBOURS + """
SELECT k.id, a.address, k.role FROM kept k JOIN address_ids a ON a.id = k.id"""),
    "graph_json": with_ledger(_NEIGHBOURS + """
, node_docs AS (
  SELECT 'node' AS element,
         '{"id":' || a.id || ',"color":"' || CASE WHEN k.id IS NOT NULL THEN '#ec5148' ELSE '#eee' END || '"}' AS json
  FROM address_ids a LEFT JOIN kept k ON k.id = a.id),
edge_docs AS (
  SELECT 'edge' AS element, '{"source":' || p.src || ',"target":' || p.dst || ',"color":"'
         || CASE WHEN p.src IN (SELECT id FROM kept) AND p.dst IN (SELECT id FROM kept) THEN '#999' ELSE '#eee' END || '"}' AS json
  FROM pay_w p)
SELECT element, json FROM node_docs UNION ALL SELECT element, json FROM edge_docs""".lstrip()),
    "clean_nodes": with_ledger("SELECT id, address FROM address_ids WHERE id % 7 <> 0"),
    "p2pk_addresses": with_ledger(", " + base58check_ctes("hash160", "h160").strip() + """
SELECT k.pubkey_hex, h.h160 AS hash160, b.address AS base58
FROM p2pk_keys k JOIN hash160 h ON h.k = k.pubkey_hex JOIN b58 b ON b.k = h.h160"""),
    "duplicate_tx_hashes": with_ledger("""
SELECT hash, 3 * count(*) AS copies FROM transactions WHERE hash LIKE '%00' GROUP BY hash"""),
    "nonstandard_addresses": with_ledger("""
SELECT address, count(*) AS n_outputs FROM outputs WHERE contains(address, '_') GROUP BY address"""),
    "balances_by_snapshot": with_ledger(f"""
SELECT {_year('t.time')} AS snapshot, s.address, CAST(sum(s.value) AS BIGINT) AS balance
FROM spent s JOIN transactions t ON t.hash = s.tx_hash
WHERE s.spent_by IS NULL GROUP BY 1, 2"""),
    "snapshot_counts": with_ledger(f"""
, stx AS (SELECT hash AS tx_hash, {_year('time')} AS snapshot FROM transactions),
bs AS (SELECT {_year('time')} AS snapshot, count(*) AS n_blocks FROM blocks GROUP BY 1),
ts AS (SELECT snapshot, count(*) AS n_tx FROM stx GROUP BY 1),
os AS (SELECT snapshot, count(*) AS n_outputs, CAST(sum(value) AS BIGINT) AS value_out
       FROM outputs o JOIN stx ON stx.tx_hash = o.tx_hash GROUP BY 1),
ins AS (SELECT snapshot, count(*) AS n_inputs FROM inputs i JOIN stx ON stx.tx_hash = i.tx_hash GROUP BY 1)
SELECT snapshot, coalesce(n_blocks, 0) AS n_blocks, coalesce(n_tx, 0) AS n_tx,
       coalesce(n_outputs, 0) AS n_outputs, coalesce(n_inputs, 0) AS n_inputs,
       coalesce(value_out, 0) AS value_out
FROM bs FULL JOIN ts USING (snapshot) FULL JOIN os USING (snapshot) FULL JOIN ins USING (snapshot)"""),
})


ORACLES["sample_outputs"] = with_ledger("""
SELECT tx_hash, ord, value, address, kind FROM outputs
WHERE substr(md5('42:' || tx_hash || ':' || ord), 1, 8) < '028f5c28'
ORDER BY md5('42:' || tx_hash || ':' || ord) LIMIT 20""")
ORACLES["edges_indexed_legacy"] = with_ledger(_EDGES_INDEXED + """
SELECT CASE WHEN edge_kind LIKE 'block%' THEN dst ELSE src END AS src,
       CASE WHEN edge_kind LIKE 'block%' THEN src ELSE dst END AS dst, value, edge_kind FROM edges_indexed""")
ORACLES["job_edges_roundtrip"] = ORACLES["edges_indexed"]
ORACLES["job_ledger_roundtrip"] = ORACLES["balances"]
ORACLES["listing_roundtrip"] = with_ledger(_CHAIN + "SELECT height AS line_no, hash FROM chain_h")
ORACLES["block_tx_ids"] = with_ledger(_CHAIN + """
SELECT c.height, t.hash FROM chain_h c JOIN transactions t ON t.block_hash = c.hash""")
ORACLES["address_json"] = with_ledger(_TOTALS + """
SELECT address AS key, CASE WHEN address LIKE '%0' THEN '' ELSE address END AS address,
       CASE WHEN address LIKE '%0' THEN -1 ELSE total_received END AS total_received,
       CASE WHEN address LIKE '%0' THEN -1 ELSE total_sent END AS total_sent,
       CASE WHEN address LIKE '%0' THEN -1 ELSE final_balance END AS final_balance,
       CASE WHEN address LIKE '%0' THEN -1 ELSE n_tx END AS n_tx
FROM totals""")

_IO_TEXTS = """
, out_t AS (
  SELECT tx_hash, ord, ' - val=' || value || ' ; adr=' || address || chr(10) || '   txRef=(' || tx_hash || ',' || ord || ')' AS text
  FROM outputs),
in_t AS (
  SELECT i.tx_hash, i.ref_hash, i.ref_ord,
         ' - val=' || coalesce(o.value, 0) || ' ; adr=' || coalesce(o.address, 'unknown') || chr(10)
         || '   txOutputRef=(' || i.ref_hash || ',' || i.ref_ord || '); tx=' || i.tx_hash AS text
  FROM inputs i LEFT JOIN outputs o ON o.tx_hash = i.ref_hash AND o.ord = i.ref_ord)
""".lstrip()
ORACLES["output_text"] = with_ledger(_IO_TEXTS + "SELECT tx_hash, ord, text FROM out_t")
ORACLES["input_text"] = with_ledger(_IO_TEXTS + "SELECT tx_hash, ref_hash, ref_ord, text FROM in_t")
ORACLES["nested_tx_text"] = with_ledger(_IO_TEXTS + f"""
, o AS (SELECT tx_hash, string_agg(text, '' ORDER BY ord) AS text FROM out_t GROUP BY 1),
i AS (SELECT tx_hash, string_agg(text, '' ORDER BY ref_hash, ref_ord) AS text FROM in_t GROUP BY 1)
SELECT t.hash, 'txId:    ' || t.hash || chr(10) || 'time:    ' || {_ts_text('t.time')} || chr(10) || 'block:   ' || t.block_hash
       || chr(10) || chr(10) || 'inputs:' || chr(10) || coalesce(i.text, '') || chr(10) || 'outputs:' || chr(10)
       || coalesce(o.text, '') || chr(10) || '----------' || chr(10) AS text
FROM transactions t LEFT JOIN o ON o.tx_hash = t.hash LEFT JOIN i ON i.tx_hash = t.hash""")
ORACLES["block_text"] = with_ledger(f"""
SELECT hash, 'block id:    ' || hash || chr(10) || 'time:    ' || {_ts_text('time')} || chr(10) || ' prev: ' || prev_hash || chr(10) AS text
FROM blocks""")


def _le(expr: str, size: int) -> str:
    """Little-endian hex of a non-negative integer."""
    padded = f"lpad(printf('%X', CAST({expr} AS BIGINT)), {2 * size}, '0')"
    return "(" + " || ".join(f"substr({padded}, {2 * i + 1}, 2)" for i in reversed(range(size))) + ")"


def _varint(n: str) -> str:
    return f"(CASE WHEN {n} < 253 THEN {_le(n, 1)} ELSE 'FD' || {_le(n, 2)} END)"


def _shown(hex_: str) -> str:
    """Double SHA-256 of serialised bytes, byte-reversed, upper case."""
    digest = f"sha256(unhex(sha256(unhex({hex_}))))"
    return f"upper(array_to_string(list_reverse(regexp_extract_all({digest}, '..')), ''))"


# the serialised transactions and blocks that ``sources.encode`` builds, and what a parser makes of them
_SERIALISED = f"""
WITH li AS (
  SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS value,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            CAST(round(l_extendedprice * 100) AS BIGINT)) - 1 AS ord,
         l_partkey % 16 AS m, upper(sha256('A' || l_partkey)) AS ha, upper(sha256('X' || l_partkey)) AS hx,
         upper(sha256('Y' || l_partkey)) AS hy
  FROM lineitem),
outs AS (
  SELECT l_orderkey, ord, value,
         CASE WHEN m <= 9 THEN '76A914' || substr(ha, 1, 40) || '88AC' WHEN m <= 11 THEN '4104' || hx || hy || 'AC'
              WHEN m = 12 THEN 'AA20' || ha || '87' WHEN m = 13 THEN '6A04' || substr(ha, 1, 8) || '00'
              WHEN m = 14 THEN '' ELSE 'A914' || substr(ha, 1, 40) || '87' END AS script
  FROM li),
out_hex AS (
  SELECT l_orderkey, count(*) AS n,
         string_agg({_le('value', 8)} || {_varint('(length(script) // 2)')} || script, '' ORDER BY ord) AS h
  FROM outs GROUP BY 1),
txs AS (
  SELECT o_orderkey, o_orderkey // 256 AS block,
         '0100000001' || upper(sha256('P' || o_orderkey)) || {_le('(o_orderkey % 65536)', 4)} || '08'
         || substr(upper(sha256('S' || o_orderkey)), 1, 16) || 'FFFFFFFF' || {_varint('coalesce(n, 0)')} || coalesce(h, '')
         || '00000000' AS tx
  FROM orders LEFT JOIN out_hex ON l_orderkey = o_orderkey),
tx_h AS (SELECT o_orderkey, block, tx, {_shown('tx')} AS hash FROM txs),
heads AS (
  SELECT block, '01000000' || upper(sha256('B' || (block - 1))) || repeat('11', 32) || {_le('(block + 1230000000)', 4)}
                || 'FFFF001D07000000' AS head, count(*) AS n, sum(length(tx)) // 2 AS size
  FROM txs GROUP BY block),
blk AS (SELECT block, n, size, {_shown('head')} AS hash,
               upper(array_to_string(list_reverse(regexp_extract_all(sha256('B' || (block - 1)), '..')), '')) AS prev
        FROM heads)
"""
ORACLES["tx_hashes"] = _SERIALISED + "SELECT o_orderkey, hash FROM tx_h"
ORACLES["ingest_ledger"] = _SERIALISED + """
SELECT 'block' AS item, hash, prev AS parent, block + 1230000000 AS n, CAST(0 AS BIGINT) AS value, '' AS script FROM blk
UNION ALL SELECT 'tx', t.hash, b.hash, b.block + 1230000000, 0, '' FROM tx_h t JOIN blk b USING (block)
UNION ALL SELECT 'output', t.hash, '', o.ord, o.value, o.script FROM outs o JOIN tx_h t ON t.o_orderkey = o.l_orderkey
UNION ALL SELECT 'input', hash, upper(array_to_string(list_reverse(regexp_extract_all(sha256('P' || o_orderkey), '..')), '')),
                 o_orderkey % 65536, 0, '' FROM tx_h"""
ORACLES["ingest_rejects"] = _SERIALISED + """
, f AS (SELECT block // 8 AS file, count(*) AS n FROM blk GROUP BY 1)
SELECT printf('blk%05d.dat', file) AS file, 'junk' AS reason, n - 1 AS places, 4 * (n - 1) AS bytes FROM f WHERE n > 1
UNION ALL SELECT printf('blk%05d.dat', file), 'padding', 1, 64 FROM f"""


ORACLES["ingest_ranges"] = ORACLES["ingest_ledger"]
ORACLES["ingest_ranges_rejects"] = ORACLES["ingest_rejects"]


def _job_table(name: str, source: str, columns: str) -> str:
    row = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns.split(", "))
    return (f"SELECT '{name}' AS \"table\", count(*) AS n, "
            f"CAST(coalesce(sum(CAST('0x' || substr(sha256({row}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS checksum FROM {source}")


# the conversion of the serialised blocks: nothing they spend is among them, and no block's parent is
ORACLES["job_tables"] = "WITH RECURSIVE " + _SERIALISED.strip().removeprefix("WITH ") + f""",
o_raw AS (SELECT t.hash AS tx_hash, o.ord, o.value, o.script AS script_hex FROM outs o JOIN tx_h t ON t.o_orderkey = o.l_orderkey),
o_kind AS (SELECT *, {_KIND} AS kind FROM o_raw),
p2pk_keys AS (SELECT DISTINCT substr(script_hex, 3, length(script_hex) - 4) AS pubkey_hex FROM o_kind WHERE kind = 'p2pk'),
{hash160_ctes('p2pk_keys', 'pubkey_hex').strip()},
o AS (SELECT *, {_ADDRESS} AS address FROM o_kind),
b AS (SELECT hash, prev AS prev_hash, block + 1230000000 AS time FROM blk),
t AS (SELECT t.hash, b.hash AS block_hash, b.block + 1230000000 AS time FROM tx_h t JOIN blk b USING (block)),
i AS (SELECT hash AS tx_hash, upper(array_to_string(list_reverse(regexp_extract_all(sha256('P' || o_orderkey), '..')), '')) AS ref_hash,
             o_orderkey % 65536 AS ref_ord FROM tx_h),
a_id AS (SELECT row_number() OVER (ORDER BY address) - 1 AS id, address FROM (SELECT DISTINCT address FROM o)),
b_id AS (SELECT row_number() OVER (ORDER BY hash) - 1 + (SELECT count(*) FROM a_id) AS id, hash, time FROM b),
t_id AS (SELECT row_number() OVER (ORDER BY hash) - 1 + (SELECT count(*) FROM a_id) + (SELECT count(*) FROM b_id) AS id, hash FROM t),
e AS (SELECT b_id.id AS src, t_id.id AS dst, 0 AS value, 'block_tx' AS edge_kind
      FROM t JOIN t_id ON t_id.hash = t.hash JOIN b_id ON b_id.hash = t.block_hash
      UNION ALL SELECT t_id.id, a_id.id, o.value, 'tx_address'
      FROM o JOIN t_id ON t_id.hash = o.tx_hash JOIN a_id ON a_id.address = o.address),
en AS (SELECT block_hash AS src, hash AS dst, 0 AS value, 'block_tx' AS edge_kind FROM t
       UNION ALL SELECT tx_hash, address, value, 'tx_address' FROM o
       UNION ALL SELECT hash, prev_hash, 0, 'block_prev' FROM b),
files AS (SELECT block // 8 AS file, count(*) AS n FROM blk GROUP BY 1),
r AS (SELECT 'junk' AS reason, 4 AS length FROM files, range(n - 1) UNION ALL SELECT 'padding', 64 FROM files)
""" + " UNION ALL ".join([
    _job_table("ledger/blocks", "b", "hash, prev_hash, time"),
    _job_table("ledger/transactions", "t", "hash, block_hash, time"),
    _job_table("ledger/outputs", "o", "tx_hash, ord, value, address, kind"),
    _job_table("ledger/inputs", "i", "tx_hash, ref_hash, ref_ord"),
    _job_table("addresses", "a_id", "id, address"), _job_table("blocks", "b_id", "id, hash, time"),
    _job_table("transactions", "t_id", "id, hash"), _job_table("edges", "e", "src, dst, value, edge_kind"),
    _job_table("edges_named", "en", "src, dst, value, edge_kind"),
    "SELECT 'payment_edges', 0, 0", _job_table("rejects", "r", "reason, length"),
    _job_table("blocks, written again", "b_id", "id, hash, time")])

ORACLES["main_chain"] = with_ledger("""
, ends AS (SELECT max(time) AS last FROM blocks),
rivals AS (SELECT hash, prev_hash, upper(sha256('F' || hash)) AS rival, time = last AS is_last FROM blocks, ends
           WHERE hash LIKE '0%' OR time = last),
forked AS (
  SELECT hash, prev_hash FROM blocks
  UNION ALL SELECT rival, prev_hash FROM rivals
  UNION ALL SELECT upper(sha256('G' || hash)), rival FROM rivals WHERE hash LIKE '00%' OR is_last
  UNION ALL SELECT upper(sha256('K' || hash)), rival FROM rivals WHERE hash LIKE '00%' OR is_last),
h(hash, prev_hash, height) AS (
  SELECT hash, prev_hash, CAST(0 AS BIGINT) FROM forked WHERE prev_hash NOT IN (SELECT hash FROM forked)
  UNION ALL SELECT f.hash, f.prev_hash, h.height + 1 FROM forked f JOIN h ON f.prev_hash = h.hash),
tip AS (SELECT hash, prev_hash FROM h ORDER BY height DESC, hash LIMIT 1),
on_main(hash, prev_hash) AS (
  SELECT hash, prev_hash FROM tip
  UNION ALL SELECT f.hash, f.prev_hash FROM forked f JOIN on_main m ON f.hash = m.prev_hash)
SELECT h.hash, h.height, m.hash IS NOT NULL AS main FROM h LEFT JOIN on_main m ON m.hash = h.hash""".lstrip())

_GRAPH = 1 << 40
ORACLES["pagerank_by_snapshot"] = with_ledger(f"""
, pay_s AS (
  SELECT g * {_GRAPH} + src AS src, g * {_GRAPH} + dst AS dst, n FROM (
    SELECT CAST({_year('t.time')} AS BIGINT) AS g, pa.id AS src, ra.id AS dst, CAST(sum(n.n_in) AS BIGINT) AS n
    FROM spent s JOIN n_in n ON n.tx_hash = s.tx_hash JOIN outputs o2 ON o2.tx_hash = s.spent_by
    JOIN transactions t ON t.hash = s.spent_by
    JOIN address_ids pa ON pa.address = o2.address JOIN address_ids ra ON ra.address = s.address
    WHERE s.spent_by IS NOT NULL GROUP BY 1, 2, 3)),
ends_s AS (SELECT src AS id FROM pay_s UNION SELECT dst FROM pay_s)""".lstrip() + _pagerank_ctes("pay_s", "ends_s", "s_") + f"""
, took AS (SELECT id // {_GRAPH} AS g, max(it) AS rounds FROM s_pr WHERE active GROUP BY 1)
SELECT CAST(f.id // {_GRAPH} AS INTEGER) AS snapshot, f.id % {_GRAPH} AS id,
       round(f.rank * (count(*) OVER (PARTITION BY f.id // {_GRAPH})) / (sum(f.rank) OVER (PARTITION BY f.id // {_GRAPH})), 6) AS rank,
       CAST(t.rounds AS INTEGER) AS rounds
FROM s_fin f JOIN took t ON t.g = f.id // {_GRAPH}""")
ORACLES["utxo_incremental"] = ORACLES["utxo"]
ORACLES["balances_incremental"] = ORACLES["balances"]

_U = "substr(md5('42:' || tx_hash || ':' || ord), 1, 8)"
# the Poisson distribution function of mean 0.05, as it stands in a table of it
ORACLES["sample_with_replacement"] = with_ledger(f"""
, term(k, p) AS (
  SELECT 0, exp(CAST(-0.05 AS DOUBLE)) UNION ALL SELECT k + 1, p * CAST(0.05 AS DOUBLE) / (k + 1) FROM term WHERE k < 12),
cdf AS (SELECT k, CAST(round((SELECT sum(p) FROM term t WHERE t.k <= term.k) * 4294967296) AS BIGINT) AS upto FROM term),
steps AS (SELECT k, printf('%08x', upto) AS upto FROM cdf WHERE upto < 4294967296)
SELECT o.tx_hash, o.ord, o.value, o.address, CAST(s.k + 1 AS INTEGER) AS copy
FROM outputs o JOIN steps s ON {_U} >= s.upto""".lstrip())

ORACLES["seed_documents"] = with_ledger("""
, seeds AS (SELECT id AS seed FROM address_ids WHERE id % 10 = 0),
near AS (
  SELECT seed, id, sum(n) AS weight, max(CAST(is_out AS INTEGER)) = 1 AS outward, min(CAST(is_out AS INTEGER)) = 0 AS inward FROM (
    SELECT s.seed, p.dst AS id, p.n, true AS is_out FROM pay_w p JOIN seeds s ON s.seed = p.src WHERE p.src <> p.dst
    UNION ALL SELECT s.seed, p.src, p.n, false FROM pay_w p JOIN seeds s ON s.seed = p.dst WHERE p.src <> p.dst) GROUP BY seed, id),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY seed ORDER BY weight DESC, id) <= 50),
docs AS (
  SELECT seed, count(*) AS k,
         string_agg('{"id":' || id || ',"color":"#ec5148"}', ',' ORDER BY id) AS nodes,
         string_agg('{"source":' || seed || ',"target":' || id || ',"color":"#999"}', ',' ORDER BY id) FILTER (WHERE outward) AS outs,
         string_agg('{"source":' || id || ',"target":' || seed || ',"color":"#999"}', ',' ORDER BY id) FILTER (WHERE inward) AS ins,
         count(*) FILTER (WHERE outward) + count(*) FILTER (WHERE inward) AS arcs FROM best GROUP BY seed)
SELECT s.seed, CAST(1 + coalesce(k, 0) AS INTEGER) AS n_nodes, CAST(coalesce(arcs, 0) AS INTEGER) AS n_edges,
       '{"nodes":[{"id":' || s.seed || ',"color":"#ec5148"}' || coalesce(',' || nodes, '') || '],"edges":['
       || concat_ws(',', outs, ins) || ']}' AS json
FROM seeds s LEFT JOIN docs d ON d.seed = s.seed""".lstrip())


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
