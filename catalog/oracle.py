"""The same results in plain SQL over the test tables.

Nothing here reads JSON: claims, lines and payments are flat columns worked out
from the test tables by the adapter's rules, and records are put together from
those.  Of the two wide records the constant bytes and the places, widths and pads of the
slots come from the layouts; the values in the slots are stated here.
"""

from __future__ import annotations

from slotline.layouts import CLAIM_HEADER, CLAIM_LINE, Slot

_BASE = """
WITH line AS (
    SELECT l_orderkey AS okey, l_partkey // 1024 AS doc,
           l_linenumber AS number, l_partkey AS part, l_suppkey AS supp, l_extendedprice AS price,
           CASE WHEN l_partkey % 2 = 0 THEN l_partkey::VARCHAR END AS icn,
           CASE WHEN l_suppkey % 4 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS service_date,
           CASE WHEN l_partkey % 5 <> 0 THEN l_returnflag END AS facility,
           CASE WHEN l_partkey % 10 <> 0 THEN l_partkey::VARCHAR END AS proc,
           CASE WHEN l_partkey % 3 <> 0 THEN '["' || l_returnflag || '", "' || l_linestatus || '"]' END AS modifiers,
           CASE WHEN l_partkey % 50 <> 0 THEN l_extendedprice::DECIMAL(12,2)::VARCHAR END AS billed,
           CASE WHEN l_partkey % 6 <> 0 THEN l_extendedprice::DECIMAL(12,2)::VARCHAR END AS allowed,
           CASE WHEN l_partkey % 2 = 1 THEN 'Z' || l_linenumber END AS code,
           l_quantity::DECIMAL(12,2)::VARCHAR AS to_provider,
           l_discount::DECIMAL(12,2)::VARCHAR AS to_bene,
           CASE WHEN l_quantity >= 25 THEN l_tax::DECIMAL(12,2)::VARCHAR END AS deductible,
           l_tax::DECIMAL(12,2)::VARCHAR AS coinsurance,
           CASE WHEN l_partkey % 7 <> 0
                THEN '[' || l_discount::DECIMAL(12,2)::VARCHAR || ', ' || l_tax::DECIMAL(12,2)::VARCHAR || ']'
                END AS cutbacks,
           CASE WHEN l_suppkey % 9 <> 0 THEN (l_suppkey + 1400000000)::VARCHAR END AS npi,
           CASE WHEN l_suppkey % 8 <> 0 THEN 'L' || l_suppkey END AS ptan,
           CASE WHEN l_suppkey % 10 <> 0 THEN (l_suppkey % 90)::VARCHAR END AS specialty,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey AS line_id,
           CASE WHEN l_partkey % 4 <> 0 THEN 'FACILITY ' || l_partkey END AS place_name,
           CASE WHEN l_partkey % 4 <> 0 THEN 'ROAD ' || l_suppkey END AS address,
           CASE WHEN l_partkey % 4 <> 0 THEN 'CITY ' || l_suppkey END AS city,
           CASE WHEN l_partkey % 4 <> 0 THEN l_linestatus END AS state,
           CASE WHEN l_partkey % 4 <> 0 THEN (l_suppkey + 10000)::VARCHAR END AS zip
    FROM lineitem
),
service AS (
    SELECT *,
           okey + doc * 1099511627776 AS id,
           row_number() OVER (PARTITION BY okey, doc ORDER BY part, supp, number, price) - 1 AS position,
           row_number() OVER (PARTITION BY okey, doc ORDER BY number, part, supp, price) AS line_sequence
    FROM line
),
documents AS (
    SELECT okey, id, count(*) AS line_count FROM service GROUP BY okey, id
),
claim AS (
    SELECT coalesce(d.id, o_orderkey) AS id, o_orderkey AS k, o_custkey, d.line_count,
           o_orderpriority, o_orderstatus, c_name, c_mktsegment, c_nationkey,
           date_trunc('quarter', o_orderdate)::DATE AS extract_date,
           CASE WHEN o_orderkey % 97 <> 0 THEN (c_nationkey + 10000)::VARCHAR END AS mac_id,
           left(o_orderpriority, 1) AS plan,
           CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey::VARCHAR END AS icn,
           CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 13 <> 0
                THEN chr(CAST(65 + o_orderkey % 26 AS INT))
                     || left((o_orderkey + 1000000)::VARCHAR, CAST(3 + o_orderkey % 5 AS INT)) END AS code,
           o_totalprice::DECIMAL(12,2)::VARCHAR AS price,
           c_acctbal::DECIMAL(12,2)::VARCHAR AS balance,
           CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 10000)::DECIMAL(9,2)::VARCHAR END AS deductible,
           strftime(o_orderdate::DATE - CAST(o_orderkey % 30 AS INT), '%Y-%m-%d') AS start_date,
           CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS end_date,
           CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS service_date,
           CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 300)::DECIMAL(9,1)::VARCHAR END AS deductible_met,
           CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 500)::DECIMAL(9,2)::VARCHAR END AS patient_paid,
           '1EG4TE5MK' || o_orderkey AS mbi,
           CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'on' WHEN 2 THEN 'f'
                               WHEN 3 THEN 'no' WHEN 4 THEN '1' END AS participating,
           CASE WHEN o_orderkey % 8 <> 0 THEN c_mktsegment END AS facility,
           CASE WHEN o_orderkey % 10 <> 0 THEN (o_orderkey % 100000)::VARCHAR END AS proc,
           CASE WHEN o_orderkey % 2 = 0 THEN 'XY' END AS modifiers,
           CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice::DECIMAL(12,2)::VARCHAR END AS billed,
           CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice::DECIMAL(12,2)::VARCHAR END AS allowed,
           CASE WHEN o_orderkey % 3 <> 0 THEN 'n/a, none' END AS cutbacks,
           CASE WHEN o_orderkey % 4 <> 0 THEN 'C' || o_custkey END AS ptan,
           CASE WHEN o_orderkey % 4 <> 0 THEN '08' END AS specialty,
           CASE WHEN o_orderkey % 5 <> 0 THEN 'TOWN' END AS city,
           CASE WHEN o_orderkey % 7 <> 0 THEN '10001-1234' END AS zip
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN documents d ON o_orderkey = d.okey
),
pay AS (
    SELECT user_id * 100 + event_id % 29 AS claim_id, ts, event_id AS e, user_id AS u, event_type AS kind,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
           value::DECIMAL(10,5) AS rate, value::DECIMAL(9,2) AS amount, event_id % 5 <> 0 AS has_provider,
           CASE WHEN event_id % 8 <> 0 THEN CASE WHEN event_id % 50 = 1 THEN '3.0' ELSE (event_id % 400)::VARCHAR END
                END AS days_text,
           CASE WHEN event_id % 8 <> 0 AND event_id % 50 <> 1 THEN CAST(event_id % 400 AS INT) END AS days,
           CASE WHEN event_id % 6 <> 0 THEN event_id::VARCHAR END AS bene_check,
           CASE WHEN event_id % 4 <> 0 AND event_id % 44 <> 1 THEN value::DECIMAL(9,2) END AS bene_interest,
           strftime(ts, '%Y-%m-%d') AS day0,
           strftime(ts::DATE + 1, '%Y-%m-%d') AS day1,
           strftime(ts::DATE + 2, '%Y-%m-%d') AS day2,
           json_extract_string(props, '$.k') AS eob
    FROM events
),
newest AS (
    SELECT * FROM pay QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY ts DESC) = 1
),
phased AS (
    SELECT claim.*, newest.* EXCLUDE (claim_id),
           CASE WHEN newest.claim_id IS NULL THEN 'P2' ELSE 'P3' END AS phase
    FROM claim LEFT JOIN newest ON claim.id = newest.claim_id
    WHERE mac_id IS NOT NULL
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY extract_date, mac_id, phase ORDER BY id) AS claim_sequence
    FROM phased
),
totals AS (
    SELECT extract_date, mac_id, phase, count(*) AS headers, CAST(sum(line_count) AS BIGINT) AS lines
    FROM phased GROUP BY ALL
),
names AS (
    SELECT *, 'P.IDR.IN.EFT.MAP.' || phase || '.' || lpad(mac_id, 5, '0') || '.D.' || strftime(extract_date, '%y%m%d')
              || '.T' || CASE WHEN month(extract_date) IN (7, 10)
                                -- summer time of those years begins on the first Sunday of April
                                OR (month(extract_date) = 4 AND dayofweek(extract_date) = 0) THEN '230405' ELSE '220405' END || '.txt' AS file_name
    FROM totals
)
"""


# Claims of whole orders: part keys in ranges of 2^20.
_WHOLE_ORDERS = _BASE.replace("l_partkey // 1024 AS doc", "l_partkey >> 20 AS doc")


def _record(layout, slots: dict[int, str]) -> str:
    """SQL for a record's text from the SQL of each slot, keyed by position."""
    parts = []
    for piece in layout.pieces():
        if isinstance(piece, Slot):
            pad = "lpad" if piece.pad[0] == "L" else "rpad"
            parts.append(f"{pad}({slots[piece.start]}, {piece.width}, '{piece.pad[1]}')")
        else:
            parts.append(f"'{piece}'")
    return " || ".join(parts)


def _packed(date: str) -> str:
    return f"replace(coalesce({date}, '0'), '-', '')"


_BY_LETTER = "CASE WHEN {any} IS NULL THEN ' ' WHEN regexp_matches({code}, '^[A-TV-Z]') THEN '0' ELSE '9' END"
_WITH_PROVIDER = "CASE WHEN has_provider THEN {} END"

_HEADER_TEXT = _record(
    CLAIM_HEADER,
    {
        4: "coalesce(plan, '0')",
        6: "coalesce(icn, '0')",
        19: "mac_id",
        24: "coalesce(line_count::VARCHAR, '0')",
        26: "coalesce('H' || u, '')",
        40: "coalesce(c_mktsegment, '')",
        46: "coalesce(c_name, '')",
        48: "o_orderstatus",
        50: _packed("day0"),
        67: "coalesce(bene_check, '')",
        78: "(o_custkey + 1000000000)::VARCHAR",
        98: "CASE WHEN k % 12 <> 0 THEN (c_nationkey + 900000000)::VARCHAR ELSE '' END",
        108: "CASE WHEN k % 2 = 0 THEN 'E' ELSE 'SYS' END",
        119: _BY_LETTER.format(any="code", code="code"),
        120: "coalesce(code, '')",
        127: "CASE WHEN code IS NULL THEN ' ' WHEN length(code) >= 7 THEN '0' ELSE '9' END",
        128: "coalesce(code, '')",
        149: "coalesce(amount::VARCHAR, '0')",
        156: "coalesce((-amount)::VARCHAR, '0')",
        172: f"coalesce({_WITH_PROVIDER.format('amount::VARCHAR')}, '')",
        179: f"coalesce({_WITH_PROVIDER.format('amount::VARCHAR')}, '0')",
        186: f"coalesce({_WITH_PROVIDER.format('(e + 5000000)::VARCHAR')}, '')",
        199: "price",
        206: "balance",
        213: "coalesce(deductible, '')",
        270: "price",
        277: _packed("start_date"),
        285: _packed("end_date"),
        294: _packed("strftime(extract_date, '%Y-%m-%d')"),
        303: "'207Q-' || o_orderpriority",
        431: "phase",
        724: "coalesce(bene_interest::VARCHAR, '0')",
        731: f"coalesce({_WITH_PROVIDER.format('amount::VARCHAR')}, '0')",
        738: "coalesce(rate::VARCHAR, '0')",
        743: "coalesce(days::VARCHAR, '0')",
        834: "CASE WHEN k % 3 <> 0 THEN (k + 1200000000)::VARCHAR ELSE '' END",
        1076: "'P' || o_custkey",
        1384: "coalesce(deductible_met, '0')",
        1587: "coalesce(kind, '')",
        1589: f"coalesce({_WITH_PROVIDER.format('left(kind, 1)')}, '')",
        1591: _packed("day0"),
        1599: _packed(_WITH_PROVIDER.format("day2")),
        1794: "'SUBMIT' || c_nationkey",
        1849: "coalesce(icn, '')",
        1864: "'PCN-' || k",
        1968: "CASE WHEN kind = 'error' THEN 'Y' ELSE 'N' END",
        1969: "CASE WHEN has_provider AND kind IN ('view', 'error') THEN 'Y' ELSE 'N' END",
        2856: "coalesce(eob, '')",
        2865: "coalesce(patient_paid, '0')",
        2889: f"coalesce({_WITH_PROVIDER.format('''('E' || e)''')}, '')",
        2944: "coalesce(patient_paid, '0')",
        5087: "left(mbi, 11)",
    },
)

_LINE_TEXT = _record(
    CLAIM_LINE,
    {
        2: "s.line_sequence::VARCHAR",
        6: "coalesce(s.icn, c.icn, '0')",
        19: "s.number::VARCHAR",
        29: "replace(coalesce(s.service_date, c.service_date, '0'), '-', ' ')",
        47: "coalesce(s.facility, c.facility, ' ')",
        48: "coalesce(s.proc, c.proc, ' ')",
        53: "coalesce(s.modifiers, c.modifiers, ' ')",
        55: "coalesce(s.modifiers, c.modifiers, ' ')",
        57: "coalesce(s.modifiers, c.modifiers, ' ')",
        59: "coalesce(s.modifiers, c.modifiers, ' ')",
        81: "coalesce(s.billed, c.billed, '0')",
        88: "coalesce(s.allowed, c.allowed, '0')",
        211: "CASE WHEN c.participating IN ('true', 'on', '1') THEN 'P' ELSE 'N' END",
        214: _BY_LETTER.format(any="coalesce(c.code, s.code)", code="c.code"),
        215: "coalesce(c.code, ' ')",
        306: "s.to_provider",
        313: "s.to_bene",
        321: "coalesce(s.deductible, c.deductible, '0')",
        384: "s.coinsurance",
        391: "coalesce(s.cutbacks, c.cutbacks, '0')",
        398: "coalesce(s.npi, (c.o_custkey + 1300000000)::VARCHAR)",
        408: "coalesce(s.ptan, c.ptan, '')",
        426: "coalesce(s.specialty, c.specialty, '')",
        921: "s.line_id",
        1109: "coalesce(s.place_name, c.c_name, '')",
        1229: "coalesce(s.address, 'STREET ' || c.k)",
        1339: "coalesce(s.city, c.city, '')",
        1369: "coalesce(s.state, 'NY')",
        1371: "coalesce(s.zip, c.zip, '')",
    },
)

_FILE_HEADER_TEXT = (
    "'MAPH' || phase || lpad(mac_id, 5, '0') || lpad(mac_id, 5, '0') || strftime(extract_date, '%Y%m%d')"
    " || 'D' || '        ' || '20250106'"
)
_TRAILER_TEXT = (
    "'MAPT' || phase || lpad(mac_id, 5, '0') || lpad(mac_id, 5, '0') || 'D'"
    " || lpad((headers + {lines} + 2)::VARCHAR, 9, '0') || lpad(headers::VARCHAR, 9, '0')"
    " || lpad(({lines})::VARCHAR, 9, '0')"
)
_CORRECTED = _TRAILER_TEXT.format(lines="coalesce(lines, 0)")
_STRICT = _TRAILER_TEXT.format(lines="lines")

_NO_SEQUENCE = "CAST(NULL AS BIGINT)"


def _sections(trailer: str = _CORRECTED) -> str:
    return f"""{_BASE},
records AS (
    SELECT extract_date, mac_id, phase, 'FILE_HEADER' AS record_type, 1 AS record_sequence,
           {_NO_SEQUENCE} AS claim_sequence, {_NO_SEQUENCE} AS line_sequence,
           {_NO_SEQUENCE} AS claim_id, {_FILE_HEADER_TEXT} AS record_content
    FROM totals
    UNION ALL
    SELECT extract_date, mac_id, phase, 'CLAIM_HEADER', claim_sequence * 1000 + 1000, claim_sequence,
           {_NO_SEQUENCE}, id, {_HEADER_TEXT}
    FROM numbered
    UNION ALL
    SELECT extract_date, mac_id, phase, 'CLAIM_LINE', c.claim_sequence * 1000 + 1000 + s.line_sequence,
           c.claim_sequence, s.line_sequence, c.id, {_LINE_TEXT}
    FROM numbered c JOIN service s ON s.id = c.id
    UNION ALL
    SELECT extract_date, mac_id, phase, 'FILE_TRAILER', 999999, {_NO_SEQUENCE}, {_NO_SEQUENCE},
           {_NO_SEQUENCE}, {trailer}
    FROM totals
),
final AS (
    SELECT file_name, records.* FROM records JOIN names USING (extract_date, mac_id, phase)
)
"""


_DAY = "extract_date::VARCHAR AS extract_date"
_FILE = f"{_DAY}, mac_id, phase"
_CHECKSUM = (
    "CAST(sum(('0x' || substr(md5({0}), 1, 8))::BIGINT + ('0x' || substr(md5({0}), 9, 8))::BIGINT * 3"
    " + ('0x' || substr(md5({0}), 17, 8))::BIGINT * 5 + ('0x' || substr(md5({0}), 25, 8))::BIGINT * 7) AS BIGINT)"
)

_FIELDS = """
WITH copies AS (
    SELECT *, unnest(CASE WHEN p_partkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM part
),
listed AS (
    SELECT p_brand AS record_type,
           upper(replace(p_name, ' ', '-')) || CASE p_size % 5 WHEN 0 THEN '-DATE' WHEN 1 THEN '-NUM'
                                                    WHEN 2 THEN '-EOMB-AMT' ELSE '' END AS field_name,
           p_partkey * 10 + 1 AS "start", p_partkey * 10 + p_size * 10 AS "end",
           CASE WHEN p_partkey % 3 = 0 THEN 'RPAD' ELSE 'LPAD' END AS pad_side,
           CAST(p_size * 10 + CASE WHEN p_partkey % 7 = 0 THEN 3 ELSE 0 END AS BIGINT) AS pad_len,
           CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE '0' END AS pad_char,
           p_partkey * 2 + copy AS line
    FROM copies
),
fields AS (
    SELECT * FROM listed
    QUALIFY row_number() OVER (PARTITION BY record_type, "start", "end", field_name ORDER BY line) = 1
),
neighbours AS (
    SELECT *, lag("end") OVER (PARTITION BY record_type ORDER BY "start", line) AS previous,
           CAST(coalesce(sum(pad_len) OVER (PARTITION BY record_type ORDER BY "start", line
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM fields
),
lengths AS (
    SELECT record_type, line, 'LENGTH_MISMATCH' AS issue, field_name, "start" AS first_position,
           "end" AS last_position, pad_len - ("end" - "start" + 1) AS size, 'ERROR' AS severity
    FROM fields WHERE pad_len <> "end" - "start" + 1
),
steps AS (
    SELECT record_type, line, CASE WHEN "start" > previous + 1 THEN 'GAP' ELSE 'OVERLAP' END AS issue, field_name,
           CASE WHEN "start" > previous + 1 THEN previous + 1 ELSE "start" END AS first_position,
           CASE WHEN "start" > previous + 1 THEN "start" - 1 ELSE previous END AS last_position,
           abs("start" - previous - 1) AS size, 'ERROR' AS severity
    FROM neighbours WHERE "start" <> previous + 1
),
paddings AS (
    SELECT record_type, line, 'PADDING_TYPE' AS issue, field_name, "start" AS first_position,
           "end" AS last_position, pad_len AS size, 'WARNING' AS severity
    FROM fields
    WHERE (field_name LIKE '%EOMB-AMT%' OR field_name LIKE '%DATE%' OR field_name LIKE '%NUM%')
      AND NOT (pad_side = 'LPAD' AND pad_char = '0')
)
"""

_RESULT = """
WITH rows AS (
    SELECT o_orderkey AS k, o_orderkey % 50 AS broken,
           'P.IDR.IN.EFT.MAP.P2.' || (o_custkey % 25 + 10000) || '.txt' AS name,
           (o_custkey % 25 + 10000)::VARCHAR AS mac_id,
           CASE o_orderkey % 5 WHEN 0 THEN 'FILE_HEADER' WHEN 1 THEN 'CLAIM_HEADER' WHEN 2 THEN 'CLAIM_LINE'
                               WHEN 3 THEN 'FILE_TRAILER' ELSE 'OTHER' END AS record_type,
           o_orderkey // 10 AS claim_sequence,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 7 END AS line_sequence,
           o_orderstatus || '  ' || rpad(o_orderpriority, 20, ' ') || '  ' || o_totalprice::DECIMAL(12,2)::VARCHAR AS t
    FROM orders
),
good AS (
    SELECT name AS file_name, mac_id, 'P2' AS phase, record_type, k AS record_sequence, claim_sequence, line_sequence,
           CASE WHEN broken = 4 THEN rpad(t, 5700, 'x') WHEN broken = 5 THEN t
                ELSE rpad(t, CAST(k % 10 + 38 AS INT), ' ') END AS record_content
    FROM rows WHERE broken NOT IN (1, 2, 3)
),
clipped AS (
    SELECT * EXCLUDE (record_content),
           left(record_content, CASE record_type WHEN 'FILE_HEADER' THEN 41 WHEN 'CLAIM_HEADER' THEN 5651
                WHEN 'CLAIM_LINE' THEN 2332 WHEN 'FILE_TRAILER' THEN 44 ELSE 99999 END) AS record_content
    FROM good
)
"""


def _per_file(relation: str, content: str) -> str:
    return f"""
SELECT file_name, count(*) AS records, CAST(sum(length({content})) AS BIGINT) AS characters,
       {_CHECKSUM.format(content)} AS checksum
FROM {relation} GROUP BY file_name"""


_FINDINGS = """
SELECT 'claim' AS document, 'lines_not_an_array' AS finding, 0::BIGINT AS occurrences
UNION ALL SELECT 'claim', 'bad_line_numbers', 0
UNION ALL SELECT 'claim', 'bad_participation_flags', 0
UNION ALL SELECT 'payment', 'bad_interestRate', 0
UNION ALL SELECT 'payment', 'bad_beneCheck_claimAmount', 0
UNION ALL SELECT 'payment', 'bad_beneCheck_claimRecoupmentAmount', 0
UNION ALL SELECT 'payment', 'bad_beneCheck_claimInterestAmount', (SELECT count(*) FROM events WHERE event_id % 44 = 1)
UNION ALL SELECT 'payment', 'bad_providerCheck_claimInterestAmount', 0
UNION ALL SELECT 'payment', 'bad_interestDaysOver',
                 (SELECT count(*) FROM events WHERE event_id % 8 <> 0 AND event_id % 50 = 1)
UNION ALL SELECT 'payment', 'bad_beneCheck_couldNotBeForwarded', 0
UNION ALL SELECT 'payment', 'bad_providerCheck_couldNotBeForwarded', 0
"""

ORACLE: dict[str, str] = {
    "scan_claims": _BASE
    + """SELECT id, mac_id, strftime(extract_date, '%Y-%m-%d') AS receipt_date, plan AS plan_code, icn,
                price AS total_billed FROM claim""",
    "scan_payments": _BASE
    + "SELECT claim_id, created_at, rate::VARCHAR AS interest_rate, days_text AS interest_days_over FROM pay",
    "extract_parameters": _BASE
    + f"""SELECT DISTINCT {_DAY}, strftime(extract_date + 1, '%Y-%m-%d') || ' 03:04:05' AS run_at FROM claim""",
    "extract_parameters_list": _BASE
    + f"""SELECT {_DAY}, strftime(extract_date + 1, '%Y-%m-%d') || ' 03:04:05' AS run_at, count(*) AS claims
          FROM claim
          WHERE mac_id IS NOT NULL AND extract_date IN (DATE '1997-07-01', DATE '1998-01-01', DATE '1998-10-01')
          GROUP BY claim.extract_date""",
    "claims_on_date": _BASE
    + f"""SELECT {_DAY}, id, mac_id, line_count FROM claim
          WHERE mac_id IS NOT NULL AND claim.extract_date = DATE '1997-07-01'""",
    "claim_phase": _BASE + f"SELECT {_FILE}, id AS claim_id FROM phased",
    "claim_key": _BASE
    + f"""SELECT {_FILE}, id AS claim_id, lpad(coalesce(plan, '0'), 2, '0') AS idr_plan,
                 lpad(coalesce(icn, '0'), 13, '0') AS idr_icn FROM phased""",
    "claim_key_semi": _BASE + "SELECT id, plan AS plan_code FROM claim WHERE id IN (SELECT id FROM phased)",
    "mac_dimension": _BASE + f"SELECT DISTINCT {_FILE} FROM phased",
    "mac_totals": _BASE
    + f"""SELECT {_FILE}, headers AS total_claim_headers, coalesce(lines, 0) AS total_claim_lines FROM totals""",
    "mac_totals_strict": _BASE
    + f"SELECT {_FILE}, headers AS total_claim_headers, lines AS total_claim_lines FROM totals",
    "payment_flat": _BASE
    + """SELECT claim_id, rate::VARCHAR AS interest_rate, days AS interest_days_over, bene_check AS bene_exchk_num,
                kind AS bene_chk_status, amount::VARCHAR AS bene_check_amt, 'H' || u AS hic, day0 AS bene_status_date,
                day1 AS bene_last_updt_dt, bene_interest::VARCHAR AS bene_int_amt, (-amount)::VARCHAR AS bene_offset,
                kind = 'error' AS bene_dnf_flg, eob AS bene_ext_eob,
                CASE WHEN has_provider THEN (e + 5000000)::VARCHAR END AS prov_exchk_num,
                CASE WHEN has_provider THEN left(kind, 1) END AS prov_chk_status,
                CASE WHEN has_provider THEN amount::VARCHAR END AS prov_check_amt,
                CASE WHEN has_provider THEN day2 END AS prov_last_updt_dt,
                CASE WHEN has_provider THEN day0 END AS prov_status_date,
                CASE WHEN has_provider THEN amount::VARCHAR END AS prov_int_amt,
                CASE WHEN has_provider THEN '0.00' END AS prov_offset,
                CASE WHEN has_provider AND kind IN ('view', 'error') THEN true
                     WHEN has_provider AND kind = 'click' THEN false END AS prov_dnf_flg,
                CASE WHEN has_provider THEN 'E' || e END AS prov_ext_eob
         FROM pay""",
    "latest_payment": _BASE
    + """SELECT created_at, amount::VARCHAR AS bene_amount,
                CASE WHEN has_provider THEN (e + 5000000)::VARCHAR END AS provider_check, claim_id FROM newest""",
    "latest_payment_lateral": _BASE
    + """SELECT p.created_at, p.amount::VARCHAR AS bene_amount,
                CASE WHEN has_provider THEN (e + 5000000)::VARCHAR END AS provider_check, claim.id
         FROM claim LEFT JOIN LATERAL (
             SELECT * FROM pay WHERE pay.claim_id = claim.id ORDER BY ts DESC LIMIT 1) p ON TRUE""",
    "claim_sequence": _BASE
    + f"""SELECT {_FILE}, id AS claim_id, claim_sequence, claim_sequence * 1000 + 1000 AS record_sequence
          FROM numbered""",
    "service_lines": _BASE
    + "SELECT id, position, number::VARCHAR AS line_number, billed, service_date FROM service",
    "line_sequence": _BASE
    + f"""SELECT {_FILE}, c.id AS claim_id, claim_sequence, line_sequence,
                 claim_sequence * 1000 + 1000 + line_sequence AS record_sequence,
                 s.number::VARCHAR AS line_number, s.line_id
          FROM numbered c JOIN service s ON s.id = c.id""",
    "json_text": _WHOLE_ORDERS
    + """SELECT id, c_mktsegment AS last_name, (o_custkey + 1000000000)::VARCHAR AS npi, balance AS coinsurance,
                deductible_met, participating FROM claim""",
    "json_nested": _BASE
    + """SELECT claim_id, created_at, bene_check, CASE WHEN kind = 'error' THEN 'true' ELSE 'false' END
                AS bene_not_forwarded, CASE WHEN has_provider THEN 'E' || e END AS provider_eob FROM pay""",
    "json_index": _BASE + "SELECT id, code AS first_code, CAST(NULL AS VARCHAR) AS third_code FROM claim",
    "json_array_len": _WHOLE_ORDERS + "SELECT id, line_count FROM claim",
    "json_nested_digits": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               '{"paid": ' || l_extendedprice::DECIMAL(12,2)::VARCHAR || ', "steps": ["' || l_returnflag || '", '
               || l_discount::DECIMAL(12,2)::VARCHAR || ', [' || l_extendedprice::DECIMAL(12,2)::VARCHAR || ']]}' AS cutbacks,
               '[' || l_discount::DECIMAL(12,2)::VARCHAR || ', "' || l_linestatus || '"]' AS line_cutbacks
        FROM lineitem
    """,
    "json_array_text": _BASE + "SELECT id, position, cutbacks, modifiers FROM service",
    "pad_scalars": """SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 3, '0') AS short_left,
        lpad(o_orderkey::VARCHAR, 13, '0') AS long_left,
        lpad(o_totalprice::DECIMAL(12,2)::VARCHAR, 7, ' ') AS price_left,
        rpad(o_totalprice::DECIMAL(12,2)::VARCHAR, 12, ' ') AS price_right,
        rpad(o_orderpriority, 6, ' ') AS priority, '    ' AS blank, '0000' AS zeros FROM orders""",
    "coalesce_fallback": _BASE
    + """SELECT c.id, s.position, coalesce(s.icn, c.icn, '0') AS icn, coalesce(s.billed, c.billed, '0') AS billed,
                coalesce(s.proc, c.proc, ' ') AS procedure_code, coalesce(s.ptan, c.ptan, '') AS ptan
         FROM claim c JOIN service s ON s.id = c.id""",
    "date_text": _BASE
    + """SELECT id, lpad(replace(coalesce(end_date, '0'), '-', ''), 8, '0') AS end_date,
                lpad(replace(coalesce(service_date, '0'), '-', ' '), 8, '0') AS line_date FROM claim""",
    "text_scalars": _BASE
    + """SELECT id, left(mbi, 11) AS mbi, length(mbi) AS mbi_length, length(coalesce(icn, '')) AS icn_length
         FROM claim""",
    "record_concat": _BASE + "SELECT id, plan || '|' || icn || '|' || o_orderstatus AS joined FROM claim",
    "diag_flags": _BASE
    + f"""SELECT id, code, {_BY_LETTER.format(any='code', code='code')} AS type_by_letter,
                 CASE WHEN code IS NULL THEN ' ' WHEN length(code) >= 7 THEN '0' ELSE '9' END AS type_by_length
          FROM claim""",
    "date_format_set": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso,
        strftime(o_orderdate, '%Y%m%d') AS packed, strftime(o_orderdate::DATE - 1, '%y%m%d') AS day_before
        FROM orders""",
    "typed_casts": _BASE
    + """SELECT claim_id, created_at, rate::VARCHAR AS rate, bene_interest::VARCHAR AS interest,
                bene_interest::VARCHAR AS interest_text, days, amount::VARCHAR AS tidied,
                CAST(amount * 100 AS BIGINT)::VARCHAR AS shifted FROM pay""",
    "boolean_flags": _BASE
    + """SELECT id, CASE WHEN participating IN ('true', 'on', '1') THEN true
                         WHEN participating IN ('f', 'no') THEN false END AS flag,
                CASE WHEN participating IN ('true', 'on', '1') THEN 'P' ELSE 'N' END AS participation FROM claim""",
    "file_header": _sections()
    + f"""SELECT {_FILE}, record_type, record_sequence, claim_sequence, line_sequence, record_content
          FROM records WHERE record_type = 'FILE_HEADER'""",
    "claim_header": _sections()
    + f"""SELECT {_FILE}, file_name, record_type, record_sequence, claim_sequence, claim_id, record_content
          FROM final WHERE record_type = 'CLAIM_HEADER'""",
    "claim_line": _sections()
    + f"""SELECT {_FILE}, file_name, record_type, record_sequence, claim_sequence, line_sequence, claim_id,
                 record_content FROM final WHERE record_type = 'CLAIM_LINE'""",
    "file_trailer": _sections()
    + f"""SELECT {_FILE}, record_type, record_sequence, claim_sequence, line_sequence, record_content
          FROM records WHERE record_type = 'FILE_TRAILER'""",
    "file_trailer_strict": _sections(_STRICT)
    + f"""SELECT {_FILE}, record_type, record_sequence, claim_sequence, line_sequence, record_content
          FROM records WHERE record_type = 'FILE_TRAILER'""",
    "file_metadata": _WHOLE_ORDERS + f"SELECT {_FILE}, file_name FROM names",
    "all_records": _sections()
    + f"""SELECT {_FILE}, file_name, record_type, record_sequence, claim_sequence, line_sequence,
                 length(record_content) AS record_length, md5(record_content) AS record_md5 FROM final""",
    "final_extract": _sections()
    + """SELECT file_name, mac_id, phase, record_type, record_sequence, claim_sequence, line_sequence, record_content
         FROM final""",
    "final_extract_strict": _sections(_STRICT)
    + "SELECT file_name, record_type, record_sequence, md5(record_content) AS record_md5 FROM final",
    "read_result_table": _RESULT + "SELECT * FROM good",
    "rejects": _RESULT
    + """SELECT CASE WHEN broken = 2 THEN '' ELSE name END AS file_name, record_type, k AS record_sequence,
                CASE WHEN broken = 1 THEN 'too_few_parts' ELSE 'empty_field' END AS reject_reason
         FROM rows WHERE broken IN (1, 2, 3)""",
    "clip_records": _RESULT + "SELECT record_sequence, record_type, record_content FROM clipped",
    "split_extract": _RESULT + _per_file("clipped", "record_content"),
    "sink_readback": _sections() + _per_file("final", "record_content"),
    "sink_two_runs": _sections() + _per_file("final", "record_content"),
    "sink_order": _sections()
    + """SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY
                    CASE record_type WHEN 'FILE_HEADER' THEN 0 WHEN 'FILE_TRAILER' THEN 2 ELSE 1 END,
                    claim_sequence, line_sequence NULLS FIRST) - 1 AS position, md5(record_content) AS md5
         FROM final""",
    "stored_relation": _sections()
    + """SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY
                    CASE record_type WHEN 'FILE_HEADER' THEN 0 WHEN 'FILE_TRAILER' THEN 2 ELSE 1 END,
                    claim_sequence, line_sequence NULLS FIRST) - 1 AS position,
                mac_id, phase, record_type, record_sequence, claim_sequence, line_sequence, md5(record_content) AS md5
         FROM final""",
    "split_order": _RESULT
    + """SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY
                    CASE record_type WHEN 'FILE_HEADER' THEN 0 WHEN 'FILE_TRAILER' THEN 2 ELSE 1 END,
                    coalesce(claim_sequence - 1, record_sequence // 1000 - 2) NULLS LAST, record_sequence NULLS LAST,
                    line_sequence NULLS FIRST, record_content) - 1 AS position, md5(record_content) AS md5
         FROM clipped""",
    "stage_two_deliveries": _BASE
    + """SELECT strftime(extract_date, '%Y-%m-%d') AS receipt_date, CASE id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS delivery,
                count(*) AS claims, CAST(coalesce(sum(line_count), 0) AS BIGINT) AS lines FROM claim GROUP BY ALL""",
    "stage_same_claim_twice": _BASE
    + """SELECT strftime(CASE WHEN id % 4 = 1 THEN extract_date + to_years(CAST(1900 - year(extract_date) AS INT))
                         ELSE extract_date END, '%Y-%m-%d') AS receipt_date,
                CASE id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'c' ELSE 'b' END AS delivery,
                count(*) AS claims, count(*) AS ids, CAST(coalesce(sum(line_count), 0) AS BIGINT) AS lines
         FROM claim GROUP BY ALL""",
    "extract_same_claim_twice": _sections().replace("FROM claim LEFT JOIN newest", "FROM (SELECT * FROM claim WHERE id % 4 <> 1) claim LEFT JOIN newest")
    + f"""SELECT {_FILE}, record_type, count(*) AS records, {_CHECKSUM.format("record_content")} AS checksum
          FROM records GROUP BY ALL""",
    "document_rejects": _BASE
    + """SELECT id, CASE WHEN id % 50 = 8 THEN 0 END AS place,
                CASE id % 50 WHEN 7 THEN 'unreadable' WHEN 8 THEN 'line is no object' ELSE 'not an object' END AS reason
         FROM claim WHERE id % 50 IN (7, 9) OR id % 50 = 8 AND line_count > 0""",
    "damaged_totals": _BASE
    + f"""SELECT {_FILE}, count(*) AS total_claim_headers,
                 CAST(coalesce(sum(line_count + CASE WHEN id % 50 = 8 THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_claim_lines
          FROM phased WHERE id % 50 NOT IN (7, 9) GROUP BY ALL""",
    "records_per_file": _sections() + "SELECT file_name, count(*) AS records FROM final GROUP BY file_name",
    "file_count": _sections() + "SELECT count(DISTINCT file_name) AS files, count(*) AS records FROM final",
    "record_widths": _sections()
    + """SELECT record_type, count(*) AS records, CAST(min(length(record_content)) AS INT) AS shortest,
                CAST(max(length(record_content)) AS INT) AS longest,
                CASE record_type WHEN 'FILE_HEADER' THEN 41 WHEN 'CLAIM_HEADER' THEN 5651
                                 WHEN 'CLAIM_LINE' THEN 2332 ELSE 44 END AS width_limit, true AS fits
         FROM records GROUP BY record_type""",
    "trailer_reconcile": _sections()
    + """, counted AS (
    SELECT file_name, count(*) AS records, count(*) FILTER (record_type = 'CLAIM_HEADER') AS claim_headers,
           count(*) FILTER (record_type = 'CLAIM_LINE') AS claim_lines,
           max(CASE WHEN record_type = 'FILE_TRAILER' THEN record_content END) AS trailer
    FROM final GROUP BY file_name
), printed AS (
    SELECT * EXCLUDE (trailer), substr(trailer, 18, 9)::BIGINT AS printed_records,
           substr(trailer, 27, 9)::BIGINT AS printed_headers, substr(trailer, 36, 9)::BIGINT AS printed_lines
    FROM counted
)
SELECT *, records = printed_records AND claim_headers = printed_headers AND claim_lines = printed_lines AS agrees
FROM printed""",
    "document_findings": _FINDINGS,
    "layout_dedupe": _FIELDS + "SELECT * FROM fields",
    "layout_length": _FIELDS + "SELECT * FROM lengths",
    "layout_gap_overlap": _FIELDS + "SELECT * FROM steps",
    "layout_padding": _FIELDS + "SELECT * FROM paddings",
    "layout_summary": _FIELDS
    + """, found AS (
    SELECT record_type, count(*) FILTER (severity = 'ERROR') AS errors,
           count(*) FILTER (severity = 'WARNING') AS warnings
    FROM (FROM lengths UNION ALL FROM steps UNION ALL FROM paddings) GROUP BY record_type
), spans AS (
    SELECT record_type, count(*) AS fields, min("start") AS first_position,
           arg_max("end", "start") AS last_position, CAST(sum(pad_len) AS BIGINT) AS total_length
    FROM fields GROUP BY record_type
)
SELECT spans.record_type, fields, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, first_position,
       last_position, total_length, last_position - first_position + 1 AS expected_length,
       total_length - (last_position - first_position + 1) AS length_difference, coalesce(errors, 0) = 0 AS passed
FROM spans LEFT JOIN found ON found.record_type = spans.record_type""",
    # The older records differ at 172-178 (two characters of status) and 1389-1391 (nine zeros).
    "adhoc_claim_header": f"""{_BASE},
every AS (
    SELECT * EXCLUDE (claim_sequence), CASE WHEN has_provider THEN left(kind, 1) END AS status FROM (
        SELECT claim.*, pay.* EXCLUDE (claim_id), n.phase, 0 AS claim_sequence
        FROM numbered n JOIN claim ON claim.id = n.id LEFT JOIN pay ON pay.claim_id = claim.id)
), phases AS (SELECT DISTINCT extract_date AS on_date, mac_id AS of_mac, phase AS file_phase FROM numbered),
text AS (
    SELECT extract_date, mac_id, phase, {_HEADER_TEXT} AS whole, rpad(coalesce(status, ''), 2, ' ') AS status
    FROM every JOIN phases ON on_date = extract_date AND of_mac = mac_id
), old AS (SELECT *, left(whole, 171) || status || substr(whole, 179) AS record_content FROM text)
SELECT {_FILE}, count(*) AS records, CAST(min(length(record_content)) AS INT) AS shortest,
       CAST(max(length(record_content)) AS INT) AS longest, {_CHECKSUM.format("record_content")} AS checksum
FROM old GROUP BY ALL""",
    "adhoc_claim_line": _sections()
    + f""", old AS (
    SELECT extract_date, mac_id, phase, left(record_content, 1388) || '000000000' || substr(record_content, 1392) AS record_content
    FROM records WHERE record_type = 'CLAIM_LINE')
SELECT {_FILE}, count(*) AS records, CAST(min(length(record_content)) AS INT) AS shortest,
       CAST(max(length(record_content)) AS INT) AS longest, {_CHECKSUM.format("record_content")} AS checksum,
       CAST(max(length(record_content) - length(left(record_content, 2332))) AS INT) AS lost
FROM old GROUP BY ALL""",
    "adhoc_header_fanout": _BASE
    + f""", answers AS (SELECT claim_id, count(*) AS n FROM pay GROUP BY claim_id),
phases AS (SELECT extract_date AS d, mac_id AS m, count(DISTINCT phase) AS n FROM phased GROUP BY ALL)
SELECT {_FILE}, count(*) AS claim_headers,
       CAST(sum(greatest(coalesce(a.n, 0), 1) * p.n) AS BIGINT) AS adhoc_headers
FROM phased LEFT JOIN answers a ON a.claim_id = phased.id
JOIN phases p ON p.d = phased.extract_date AND p.m = phased.mac_id
GROUP BY phased.extract_date, mac_id, phase""",
    "adhoc_width_drift": _FIELDS
    + """SELECT record_type, field_name, line, "start", pad_len - ("end" - "start" + 1) AS mismatch,
                before + 1 - "start" AS shift FROM neighbours""",
}
