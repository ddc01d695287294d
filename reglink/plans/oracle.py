"""DuckDB oracle SQL: the naive definitions (cross joins with the full score),
over the same derived tables.  Used by the driver's correctness gate and by
the tests; never on the Spark execution path."""

from __future__ import annotations

from reglink.sources.fixtures import ORACLE_CTE


def clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def sim_ok(a: str, b: str) -> str:
    """edit similarity >= 0.9 in integers; blank never matches."""
    return (f"(length({a}) > 0 AND length({b}) > 0 AND "
            f"10 * levenshtein({a}, {b}) <= greatest(length({a}), length({b})))")


def edit_score(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return f"CAST((100 * ({m} - levenshtein({a}, {b}))) // {m} AS INTEGER)"


CLEAN_CTE = f"""
pend_clean AS (
  SELECT death_main_id,
         {clean('DEATH_DECEASED_NAME')} AS p_name,
         {clean('DEATH_FATHER_NAME')} AS p_father,
         ({clean('DEATH_FATHER_NAME')} = '' OR {clean('DEATH_FATHER_NAME')} IS NULL) AS name_only
  FROM pending
),
reg_clean AS (
  SELECT PERMANENT_RCNO AS rc_no, NAME AS rc_name, FATHERNAME AS rc_father_name,
         BlockMunicipalityCode AS rc_blockmunicipalitycode, RCCATEGORY AS rc_category, district,
         {clean("coalesce(NAME, '')")} AS r_name, {clean("coalesce(FATHERNAME, '')")} AS r_father
  FROM register
),
p2 AS (SELECT * FROM pend_clean WHERE NOT name_only AND length(p_name) > 0 AND length(p_father) > 0),
r2 AS (SELECT * FROM reg_clean WHERE length(r_name) > 0 AND length(r_father) > 0),
chunked AS (
  SELECT death_main_id, CAST((row_number() OVER (ORDER BY death_main_id) - 1) // 100 + 1 AS BIGINT) AS chunk_id
  FROM pending
)"""

PERSON_SELECT = ("p.death_main_id, r.rc_no, r.rc_name, r.rc_father_name, "
                 "r.rc_blockmunicipalitycode, r.rc_category, r.district")


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    ctes = ORACLE_CTE + "," + CLEAN_CTE + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


NAME_ONLY = f"""SELECT {PERSON_SELECT} FROM pend_clean p JOIN reg_clean r
  ON p.name_only AND length(p.p_name) > 0 AND p.p_name = r.r_name"""

NAME_MATCH = f"SELECT {PERSON_SELECT} FROM p2 p JOIN r2 r ON {sim_ok('p.p_name', 'r.r_name')}"

NAME_FATHER = (f"SELECT {PERSON_SELECT} FROM p2 p JOIN r2 r ON {sim_ok('p.p_name', 'r.r_name')} "
               f"AND {sim_ok('p.p_father', 'r.r_father')}")

CHAINED_CTES = f"""
p2c AS (SELECT p2.*, c.chunk_id FROM p2 JOIN chunked c USING (death_main_id)),
m AS (SELECT p.chunk_id, r.* FROM p2c p JOIN r2 r ON {sim_ok('p.p_name', 'r.r_name')})"""

NAME_FATHER_CHAINED = (f"SELECT p.death_main_id, r.rc_no, r.rc_name, r.rc_father_name, "
                       f"r.rc_blockmunicipalitycode, r.rc_category, r.district "
                       f"FROM p2c p JOIN m r ON p.chunk_id = r.chunk_id AND {sim_ok('p.p_father', 'r.r_father')}")

PERSON_EVIDENCE = (f"SELECT *, 'name_father' AS branch FROM ({NAME_FATHER}) "
                   f"UNION ALL SELECT *, 'name_only' AS branch FROM ({NAME_ONLY})")


# ---------------------------------------------------------------------------
# token_set_ratio, naive: every (record, gazetteer row) pair is scored
# ---------------------------------------------------------------------------

def norm_tokens(x: str) -> str:
    norm = (f"trim(lower(regexp_replace(regexp_replace({x}, '[\\x{{80}}-\\x{{FF}}]', '', 'g'), "
            f"'[^a-zA-Z0-9_]', ' ', 'g')))")
    return f"list_sort(list_distinct(list_filter(string_split({norm}, ' '), lambda t: t <> '')))"


def lcs(a: str, b: str) -> str:
    """Bit-parallel LCS with a HUGEINT bit vector (|a| <= 126)."""
    return (f"(length({a}) - bit_count(list_reduce("
            f"list_transform(string_split({b}, ''), lambda ch: list_sum(list_transform(range(length({a})), lambda i: "
            f"CASE WHEN substr({a}, (i + 1)::INTEGER, 1) = ch THEN (1::HUGEINT << i::INTEGER) ELSE 0::HUGEINT END))::HUGEINT), "
            f"lambda v, x: (((v + (v & x)) | (v - (v & x))) & ((1::HUGEINT << length({a})::INTEGER) - 1)), "
            f"(1::HUGEINT << length({a})::INTEGER) - 1)))")


def ratio_prefix(p: str, x: str) -> str:
    return (f"(CASE WHEN length({p}) = 0 OR length({x}) = 0 THEN 0 "
            f"ELSE round_even(200.0 * length({p}) / (length({p}) + length({x})), 0) END)")


def ratio_lcs(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
            f"ELSE round_even(200.0 * {lcs(a, b)} / (length({a}) + length({b})), 0) END)")


def token_set_match(left: str, lkey: str, ltext: str, right: str, rkey: str, rtext: str,
                    out_l: str, out_r: str, threshold: int = 80, px: str = "") -> tuple[str, str]:
    """(extra CTEs, final SELECT) for the naive token_set join; ``px`` prefixes CTE names."""
    ctes = f"""
{px}ta AS (SELECT {lkey} AS lk, {norm_tokens(ltext)} AS A FROM {left}),
{px}tb AS (SELECT {rkey} AS rk, {norm_tokens(rtext)} AS B FROM {right}),
{px}tp AS (SELECT lk, rk, A, B,
         array_to_string(list_sort(list_intersect(A, B)), ' ') AS t0,
         array_to_string(list_sort(list_filter(A, lambda t: NOT list_contains(B, t))), ' ') AS sab,
         array_to_string(list_sort(list_filter(B, lambda t: NOT list_contains(A, t))), ' ') AS sba
       FROM {px}ta, {px}tb WHERE len(A) > 0 AND len(B) > 0),
{px}tt AS (SELECT lk, rk, t0, trim(t0 || ' ' || sab) AS t1, trim(t0 || ' ' || sba) AS t2 FROM {px}tp),
{px}ts AS (SELECT lk, rk, CAST(greatest({ratio_prefix('t0', 't1')}, {ratio_prefix('t0', 't2')}, {ratio_lcs('t1', 't2')}) AS INTEGER) AS score FROM {px}tt)"""
    body = f"SELECT lk AS {out_l}, rk AS {out_r}, score FROM {px}ts WHERE score >= {threshold}"
    return ctes, body


BLOCK_CTES, BLOCK_BODY = token_set_match("pending", "death_main_id", "death_address",
                                         "blocks", "BlockCode", "BlockName", "death_main_id", "block_id")
PIN_CTES, PIN_BODY = token_set_match("pending", "death_main_id", "death_address",
                                     "pins", "Pincode", "Pincode", "death_main_id", "matched_pin")

BLOCK_CONTAINED = f"""
SELECT p.death_main_id, b.BlockCode AS block_id
FROM (SELECT death_main_id, {norm_tokens('death_address')} AS A FROM pending) p,
     (SELECT BlockCode, {norm_tokens('BlockName')} AS B FROM blocks) b
WHERE len(b.B) > 0 AND list_has_all(p.A, b.B)"""


# ---------------------------------------------------------------------------
# cleaning, sources, chunks, reports
# ---------------------------------------------------------------------------

def strip_punct(x: str) -> str:
    return f"regexp_replace({x}, '[^\\w\\s]', '', 'g')"


CLEAN_NAMES = (f"SELECT death_main_id, {clean('DEATH_DECEASED_NAME')} AS clean_name, "
               f"{clean('DEATH_FATHER_NAME')} AS clean_father FROM pending")
CLEAN_DOCUMENTS = f"SELECT doc_id, {clean('text')} AS clean_text FROM documents"
STRIP_PUNCT = (f"SELECT death_main_id, {strip_punct('DEATH_DECEASED_NAME')} AS death_name, "
               f"{strip_punct('DEATH_FATHER_NAME')} AS death_father_name FROM pending")
ADDRESS_PARTS = "DEATH_RESIDENCE, DEATH_RESIDENCE_STREET, DEATH_RESIDENCE_PREMISES, DEATH_RESIDENCE_DIST, DEATH_RESIDENCE_STATE"
CONCAT_ADDRESS = f"SELECT row_id, concat_ws(',', {ADDRESS_PARTS}) AS full_address FROM uploads"
INGEST_UPLOADS = (f"SELECT {strip_punct('DEATH_DECEASED_NAME')} AS death_name, "
                  f"{strip_punct('DEATH_FATHER_NAME')} AS death_father_name, "
                  f"concat_ws(',', {ADDRESS_PARTS}) AS death_address FROM uploads")
REGISTER_UNION = "SELECT * FROM register"
PIN_LIST = "SELECT Pincode FROM pins"

CHUNK_CTE = """
chunks AS (
  SELECT id, CAST((rn - 1) // 100 + 1 AS BIGINT) AS chunk_id, CAST(rn AS BIGINT) AS position
  FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM pending_main WHERE is_send = 0)
)"""
PENDING_CHUNKS = "SELECT id, chunk_id, position FROM chunks"
CHUNK_STATS = ("SELECT count(id) AS pending_count, CAST(ceil(count(id) / 100.0) AS BIGINT) AS chunk_count "
               "FROM pending_main WHERE is_send = 0")
CHUNK_ID_LISTS = ("SELECT chunk_id, upper(substr(md5(CAST(chunk_id AS VARCHAR)), 1, 9)) AS chunk_name, "
                  "string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS id_list FROM chunks GROUP BY chunk_id")
IDS_FROM_LIST = "SELECT chunk_id, id FROM chunks"
STILL_PENDING = ("SELECT * FROM pending_main WHERE is_send = 0 "
                 "AND id NOT IN (SELECT id FROM chunks WHERE chunk_id <= 5)")

_B_CTES, _B_BODY = token_set_match("pending", "death_main_id", "death_address", "blocks", "BlockCode",
                                   "BlockName", "death_main_id", "block_id", px="b_")
_N_CTES, _N_BODY = token_set_match("pending", "death_main_id", "death_address", "pins", "Pincode",
                                   "Pincode", "death_main_id", "matched_pin", px="n_")
EVIDENCE_CTES = (_B_CTES + "," + _N_CTES + f""",
block_ev AS ({_B_BODY}),
pin_ev AS ({_N_BODY}),
person_ev AS ({PERSON_EVIDENCE})""")

UNMATCHED = """
SELECT death_main_id, 'block' AS evidence FROM pending p WHERE NOT EXISTS (SELECT 1 FROM block_ev e WHERE e.death_main_id = p.death_main_id)
UNION ALL
SELECT death_main_id, 'pin' AS evidence FROM pending p WHERE NOT EXISTS (SELECT 1 FROM pin_ev e WHERE e.death_main_id = p.death_main_id)
UNION ALL
SELECT death_main_id, 'person' AS evidence FROM pending p WHERE NOT EXISTS (SELECT 1 FROM person_ev e WHERE e.death_main_id = p.death_main_id)"""

MATCH_COUNTS = f"""
SELECT c.chunk_id, e.district, e.branch, count(*) AS match_count
FROM ({PERSON_EVIDENCE}) e JOIN chunked c USING (death_main_id)
GROUP BY c.chunk_id, e.district, e.branch"""

PENDING_COLUMNS = [("death_main_id", "bigint"), ("DEATH_DECEASED_NAME", "string"),
                   ("DEATH_FATHER_NAME", "string"), ("death_address", "string")]
COLUMN_PROFILE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null, '{t}' AS dtype FROM pending"
    for c, t in PENDING_COLUMNS)

SCORECARD_CTE = f"""
card AS (
  SELECT e.death_main_id, e.rc_no, e.branch,
         {edit_score('p.p_name', 'e.r_name')} AS name_score,
         CASE WHEN e.branch = 'name_father' THEN {edit_score('p.p_father', 'e.r_father')} END AS father_score,
         (SELECT CAST(max(b.score) AS INTEGER) FROM block_ev b
           WHERE b.death_main_id = e.death_main_id AND b.block_id = e.rc_blockmunicipalitycode) AS block_score,
         (SELECT CAST(max(n.score) AS INTEGER) FROM pin_ev n WHERE n.death_main_id = e.death_main_id) AS pin_score
  FROM (SELECT *, {clean("coalesce(rc_name, '')")} AS r_name, {clean("coalesce(rc_father_name, '')")} AS r_father FROM person_ev) e
       JOIN pend_clean p USING (death_main_id)
)"""
SCORECARD = "SELECT * FROM card"
BEST_MATCH = """
SELECT death_main_id, rc_no, branch, name_score + coalesce(father_score, 0) AS total_score FROM card
QUALIFY row_number() OVER (PARTITION BY death_main_id
                           ORDER BY name_score + coalesce(father_score, 0) DESC, rc_no ASC, branch ASC) = 1"""

ELAPSED_TEXT = """
SELECT user_id, n_events,
       CAST(s // 3600 AS VARCHAR) || ' Hour ' || CAST((s % 3600) // 60 AS VARCHAR) || ' Minutes '
         || CAST(s % 60 AS VARCHAR) || ' Seconds' AS elapsed_text
FROM (SELECT user_id, count(*) AS n_events,
             CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS BIGINT) AS s
      FROM events GROUP BY user_id)"""

PEEK = f"SELECT * FROM ({PERSON_EVIDENCE}) ORDER BY death_main_id, rc_no, branch LIMIT 5"
REGISTER_SLICE = "SELECT * FROM register ORDER BY PERMANENT_RCNO LIMIT 100 OFFSET 100"

NAME_ONLY_STRICT = f"""SELECT {PERSON_SELECT} FROM pend_clean p JOIN reg_clean r
  ON coalesce(p.p_father = '', false) AND length(p.p_name) > 0 AND p.p_name = r.r_name"""
NAME_FATHER_STRICT = (f"SELECT {PERSON_SELECT} FROM pend_clean p JOIN r2 r ON "
                      f"NOT coalesce(p.p_father = '', false) AND length(p.p_name) > 0 AND length(p.p_father) > 0 "
                      f"AND {sim_ok('p.p_name', 'r.r_name')} AND {sim_ok('p.p_father', 'r.r_father')}")
PERSON_EVIDENCE_STRICT = (f"SELECT *, 'name_father' AS branch FROM ({NAME_FATHER_STRICT}) "
                          f"UNION ALL SELECT *, 'name_only' AS branch FROM ({NAME_ONLY_STRICT})")

SCORECARD_STRONG = "SELECT * FROM card WHERE name_score >= 90 AND father_score >= 90"
GAZETTEER_ROUNDTRIP = ("SELECT BlockCode, BlockName AS name FROM blocks "
                       "UNION ALL SELECT Pincode AS BlockCode, Pincode AS name FROM pins")


def sim_ok_damerau(a: str, b: str) -> str:
    """Damerau-Levenshtein similarity >= 0.9 in integers; blank never matches."""
    return (f"(length({a}) > 0 AND length({b}) > 0 AND "
            f"10 * damerau_levenshtein({a}, {b}) <= greatest(length({a}), length({b})))")


NAME_FATHER_DAMERAU = (f"SELECT {PERSON_SELECT} FROM p2 p JOIN r2 r ON {sim_ok_damerau('p.p_name', 'r.r_name')} "
                       f"AND {sim_ok_damerau('p.p_father', 'r.r_father')}")

PIPELINE_EVIDENCE = """
SELECT death_main_id, 'block' AS evidence, block_id AS ref_id, score FROM block_ev
UNION ALL SELECT death_main_id, 'pin' AS evidence, matched_pin AS ref_id, score FROM pin_ev
UNION ALL SELECT death_main_id, 'person' AS evidence, rc_no AS ref_id, CAST(NULL AS INTEGER) AS score FROM person_ev"""

CSV_QUEUE = f"""{PIPELINE_EVIDENCE}
UNION ALL SELECT death_main_id, 'no ' || evidence AS evidence, CAST(NULL AS VARCHAR) AS ref_id, CAST(NULL AS INTEGER) AS score FROM ({UNMATCHED})
UNION ALL SELECT CAST(NULL AS BIGINT) AS death_main_id, 'failed file' AS evidence, 'a value does not cast: death_main_id' AS ref_id, CAST(NULL AS INTEGER) AS score"""

CLAIM_TWICE = """
SELECT id, chunk_id, 1 AS claim_no FROM chunks WHERE chunk_id <= 3
UNION ALL SELECT id, chunk_id, 2 AS claim_no FROM chunks WHERE chunk_id IN (4, 5)
UNION ALL SELECT id, chunk_id, 3 AS claim_no FROM chunks WHERE chunk_id <= 3"""

CHUNK_CSV = """
SELECT death_main_id, DEATH_DECEASED_NAME, DEATH_FATHER_NAME,
       'House "' || CAST(death_main_id AS VARCHAR) || '", Ward' || chr(10) || death_address AS death_address,
       lpad(CAST(death_main_id AS VARCHAR), 12, '0') AS card FROM pending"""

CSV_EVIDENCE = """
SELECT 'block' AS kind, concat_ws('|', CAST(death_main_id AS VARCHAR), block_id) AS line FROM block_ev
UNION ALL SELECT 'pin' AS kind, concat_ws('|', CAST(death_main_id AS VARCHAR), matched_pin) AS line FROM pin_ev
UNION ALL SELECT 'person' AS kind, concat_ws('|', CAST(death_main_id AS VARCHAR), rc_no, rc_name, rc_father_name,
                                             rc_blockmunicipalitycode, rc_category) AS line FROM person_ev"""

RERUN_SHRINKS = f"""
SELECT e.*, c.chunk_id FROM ({PERSON_EVIDENCE}) e JOIN chunked c USING (death_main_id)
WHERE c.chunk_id > 1 AND e.death_main_id % 5 <> 0"""

EDIT_JOIN_KEEP = f"""
SELECT p.death_main_id, r.PERMANENT_RCNO, r.district FROM pending p JOIN register r
  ON {sim_ok('lower(p.DEATH_DECEASED_NAME)', 'lower(r.NAME)')}"""

INGEST_CTES = f"""
loaded AS (
  SELECT 'upload_' || CAST(row_id % 3 AS VARCHAR) AS file_name, {strip_punct('DEATH_DECEASED_NAME')} AS death_name,
         {strip_punct('DEATH_FATHER_NAME')} AS death_father_name, concat_ws(',', {ADDRESS_PARTS}) AS death_address
  FROM uploads
),
claimed AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY file_name, death_address, death_name, death_father_name) AS id FROM loaded)
  WHERE id <= 200
),
up AS (
  SELECT id AS death_main_id, CAST((id - 1) // 100 + 1 AS BIGINT) AS chunk_id, file_name,
         {clean('death_name')} AS p_name, {clean('death_father_name')} AS p_father FROM claimed
)"""

RELOAD_CTES = f"""
loaded AS (
  SELECT 'b' || CAST(1 + row_id % 2 AS VARCHAR) AS batch, 'upload_' || CAST(row_id % 3 AS VARCHAR) AS file_name,
         {strip_punct('DEATH_DECEASED_NAME')} AS death_name, {strip_punct('DEATH_FATHER_NAME')} AS death_father_name,
         concat_ws(',', {ADDRESS_PARTS}) AS death_address
  FROM uploads
)"""
RELOAD_KEEPS_IDS = """
SELECT id, CAST((id - 1) // 100 + 1 AS BIGINT) AS chunk_id, batch, file_name, death_name, death_father_name, death_address
FROM (SELECT *, row_number() OVER (ORDER BY batch, file_name NULLS FIRST, death_address NULLS FIRST, death_name NULLS FIRST,
                                            death_father_name NULLS FIRST) AS id FROM loaded)
WHERE id <= 400"""

INGEST_CLAIM_MATCH = f"""
SELECT p.death_main_id, p.chunk_id, p.file_name, r.rc_no, 'name_father' AS branch FROM up p JOIN r2 r
  ON coalesce(p.p_father, '') <> '' AND {sim_ok('p.p_name', 'r.r_name')} AND {sim_ok('p.p_father', 'r.r_father')}
UNION ALL
SELECT p.death_main_id, p.chunk_id, p.file_name, r.rc_no, 'name_only' AS branch FROM up p JOIN reg_clean r
  ON coalesce(p.p_father, '') = '' AND length(p.p_name) > 0 AND p.p_name = r.r_name"""
