"""Independent SQL (DuckDB dialect) for every registered query with an oracle.

Written from the operator definitions, not generated from the Spark plans:
the role views, cleaning contracts, vocabulary numbering, visit grouping and
metrics are restated as plain SQL over the driver's pre-registered views.
"""

from __future__ import annotations

# Upper bounds of the train and test buckets: 65 % and 85 % of 2**32, rounded down.
_T1, _T2 = 2791728742, 3650722201

# JVM-style trim (chars U+0000..U+0020), ICD-9 category, token normalisation.
_JT = "regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def jt(x: str) -> str:
    return _JT.format(x=x)


def cat(x: str) -> str:
    t = jt(x)
    return f"(CASE WHEN length({t}) = 0 THEN NULL WHEN starts_with({t}, 'E') THEN substr({t}, 1, 4) ELSE substr({t}, 1, 3) END)"


def norm(x: str) -> str:
    return f"lower({jt(x)})"


def hashed(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 4))::BIGINT"


def bucket(x: str, seed: int) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT"


def day(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]{{1,4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN TRY_CAST({x} AS DATE) END)"


ROLES = """
raw_patients AS (
  SELECT CASE WHEN c_custkey % 41 = 7 THEN 'P' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS SUBJECT_ID,
         CASE WHEN c_acctbal < 0 THEN 'x' END AS DOD_HOSP
  FROM customer WHERE c_custkey % 37 <> 5),
ord AS (
  SELECT *, CASE WHEN o_custkey % 41 = 7 THEN 'P' || o_custkey WHEN o_custkey % 20 = 1 THEN '1'
                 ELSE CAST(o_custkey AS VARCHAR) END AS sid
  FROM orders),
raw_admissions AS (
  SELECT sid AS SUBJECT_ID, CAST(o_orderkey AS VARCHAR) AS HADM_ID,
         CASE WHEN o_orderkey % 199 = 0 THEN strftime(o_orderdate, '%Y') || '-13-45 00:00:00'
              WHEN o_custkey % 31 = 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END
              ELSE strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00'
         END AS ADMITTIME
  FROM (SELECT * FROM ord UNION ALL SELECT * FROM ord WHERE o_orderkey % 101 = 9)),
raw_icustays AS (
  SELECT sid AS SUBJECT_ID, CAST(o_orderkey AS VARCHAR) AS HADM_ID,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS ICUSTAY_ID,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_totalprice / 10000 AS VARCHAR) END AS LOS
  FROM ord),
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, o.o_custkey, o.sid
  FROM lineitem l JOIN ord o ON l.l_orderkey = o.o_orderkey),
raw_diagnoses AS (
  SELECT sid AS SUBJECT_ID, CAST(l_orderkey AS VARCHAR) AS HADM_ID,
         CASE WHEN l_partkey % 61 = 0 THEN NULL
              WHEN l_partkey % 53 = 0 THEN '   '
              WHEN l_partkey % 59 = 0 THEN chr(9) || lpad(CAST(l_partkey % 10000 AS VARCHAR), 5, '0') || ' '
              WHEN l_partkey % 10 = 0 THEN 'E' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 4, '8')
              ELSE lpad(CAST(l_partkey % 10000 AS VARCHAR), 5, '0') END AS ICD9_CODE
  FROM li),
lip AS (
  SELECT li.*, p.p_name, p.p_brand FROM li JOIN part p ON li.l_partkey = p.p_partkey),
raw_prescriptions AS (
  SELECT sid AS SUBJECT_ID, CAST(l_orderkey AS VARCHAR) AS HADM_ID,
         CASE WHEN l_orderkey % 97 = 5 THEN 'rare ' || o_custkey
              WHEN l_orderkey % 89 = 7 THEN substr(lpad(CAST(l_partkey % 10000 AS VARCHAR), 5, '0'), 1, 3)
              WHEN l_linenumber = 3 AND l_partkey % 7 = 0 THEN ''
              WHEN l_linenumber % 2 = 0 THEN '  ' || upper(p_name) || ' ' ELSE p_name END AS DRUG
  FROM lip),
raw_labevents AS (
  SELECT sid AS SUBJECT_ID,
         CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS HADM_ID,
         CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE p_brand END AS ITEMID,
         CASE WHEN l_suppkey % 13 = 0 THEN 'n/a' WHEN l_suppkey % 17 = 0 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS VALUENUM
  FROM lip)"""

PREP = f"""
cohort AS (
  SELECT DISTINCT SUBJECT_ID FROM raw_icustays WHERE ICUSTAY_ID IS NOT NULL AND SUBJECT_ID IS NOT NULL),
cohort_split AS (
  SELECT SUBJECT_ID,
         CASE WHEN b < {_T1} THEN 'train' WHEN b < {_T2} THEN 'test' ELSE 'valid' END AS split
  FROM (SELECT SUBJECT_ID, {bucket('SUBJECT_ID', 1)} AS b FROM cohort)),
p_admissions AS (
  SELECT r.SUBJECT_ID, r.HADM_ID, r.ADMITTIME, c.split FROM raw_admissions r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID),
p_diagnoses AS (
  SELECT r.SUBJECT_ID, r.HADM_ID, r.ICD9_CODE, c.split FROM raw_diagnoses r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID),
p_icustays AS (
  SELECT r.SUBJECT_ID, r.HADM_ID, r.ICUSTAY_ID, COALESCE(TRY_CAST(r.LOS AS DOUBLE), 0.0::DOUBLE) AS LOS, c.split
  FROM raw_icustays r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID),
labs_c AS (
  SELECT r.SUBJECT_ID, r.HADM_ID, r.ITEMID, r.VALUENUM AS RAW_VALUE, TRY_CAST(r.VALUENUM AS DOUBLE) AS VALUENUM, c.split
  FROM raw_labevents r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID),
lab_max AS (
  SELECT split, max(VALUENUM) AS max_value FROM labs_c WHERE VALUENUM IS NOT NULL GROUP BY split),
p_labevents AS (
  SELECT l.SUBJECT_ID, l.HADM_ID, l.ITEMID, l.VALUENUM / NULLIF(m.max_value, 0) AS VALUENUM, l.split
  FROM labs_c l JOIN lab_max m ON l.split = m.split WHERE l.VALUENUM IS NOT NULL),
p_patients AS (
  SELECT r.SUBJECT_ID, CASE WHEN r.DOD_HOSP IS NULL THEN 0 ELSE 1 END AS IS_DEAD, c.split
  FROM raw_patients r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID),
p_prescriptions AS (
  SELECT r.SUBJECT_ID, r.HADM_ID, r.DRUG, c.split FROM raw_prescriptions r JOIN cohort_split c ON r.SUBJECT_ID = c.SUBJECT_ID)"""


def _miss(c: str, text: bool = True) -> str:
    cond = f"{c} IS NULL OR {c} = ''" if text else f"{c} IS NULL"
    return f"WHEN {cond} THEN 'missing {c}'"


_BAD_SUBJECT = "WHEN TRY_CAST(SUBJECT_ID AS BIGINT) IS NULL THEN 'bad SUBJECT_ID'"

RECS = f"""
v_admissions AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, HADM_ID AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id,
         ({day('ADMITTIME')} - DATE '1970-01-01') * 86400000 AS admit_ms,
         CASE {_miss('SUBJECT_ID')} {_miss('HADM_ID')} {_miss('ADMITTIME')} {_BAD_SUBJECT}
              WHEN {day('ADMITTIME')} IS NULL THEN 'bad ADMITTIME' END AS reason
  FROM p_admissions),
v_diagnoses AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, HADM_ID AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id, ICD9_CODE AS code,
         CASE {_miss('SUBJECT_ID')} {_miss('HADM_ID')} {_miss('ICD9_CODE')} {_BAD_SUBJECT}
              WHEN {cat('ICD9_CODE')} IS NULL THEN 'bad ICD9_CODE' END AS reason
  FROM p_diagnoses),
v_prescriptions AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, HADM_ID AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id, DRUG AS drug,
         CASE {_miss('SUBJECT_ID')} {_miss('HADM_ID')} {_miss('DRUG')} {_BAD_SUBJECT} END AS reason
  FROM p_prescriptions),
v_labevents AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, HADM_ID AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id, ITEMID AS item, VALUENUM AS value,
         CASE {_miss('SUBJECT_ID')} {_miss('HADM_ID')} {_miss('ITEMID')} {_miss('VALUENUM', False)} {_BAD_SUBJECT} END AS reason
  FROM p_labevents),
v_icustays AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, HADM_ID AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id, ICUSTAY_ID AS icustay_id, LOS AS los,
         CASE {_miss('SUBJECT_ID')} {_miss('HADM_ID')} {_miss('ICUSTAY_ID')} {_miss('LOS', False)} {_BAD_SUBJECT} END AS reason
  FROM p_icustays),
v_patients AS (
  SELECT split, SUBJECT_ID AS raw_subject_id, NULL::VARCHAR AS raw_hadm_id,
         TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, IS_DEAD AS is_dead,
         CASE {_miss('SUBJECT_ID')} {_miss('IS_DEAD', False)} {_BAD_SUBJECT} END AS reason
  FROM p_patients),
r_admissions AS (SELECT split, patient_id, hadm_id, admit_ms FROM v_admissions WHERE reason IS NULL),
r_diagnoses AS (SELECT split, patient_id, hadm_id, code FROM v_diagnoses WHERE reason IS NULL),
r_prescriptions AS (SELECT split, patient_id, hadm_id, drug FROM v_prescriptions WHERE reason IS NULL),
r_labevents AS (SELECT split, patient_id, hadm_id, item, value FROM v_labevents WHERE reason IS NULL),
r_icustays AS (SELECT split, patient_id, hadm_id, icustay_id, los FROM v_icustays WHERE reason IS NULL),
r_patients AS (SELECT split, patient_id, is_dead FROM v_patients WHERE reason IS NULL)"""

VOCAB = f"""
toks AS (
  SELECT DISTINCT 'diagnosis' AS domain, 0 AS domain_rank, {cat('code')} AS token FROM r_diagnoses WHERE split = 'train'
  UNION
  SELECT DISTINCT 'medication', 1, {norm('drug')} FROM r_prescriptions WHERE split = 'train'
  UNION
  SELECT DISTINCT 'lab', 2, {norm('item')} FROM r_labevents WHERE split = 'train'),
tok_idx AS (
  SELECT domain, domain_rank, token, row_number() OVER (ORDER BY domain_rank, token) - 1 AS pos
  FROM toks WHERE token IS NOT NULL),
entries AS (
  SELECT domain, domain_rank, token, pos + CASE WHEN domain_rank >= 1 THEN 1 ELSE 0 END AS feature_id FROM tok_idx
  UNION ALL
  SELECT 'icu', 3, 'ICUStayDuration', (SELECT count(*) FROM tok_idx) + 1),
vocab AS (
  SELECT token, arg_max(feature_id, domain_rank) AS feature_id, arg_max(domain, domain_rank) AS domain
  FROM entries GROUP BY token)"""

DS = f"""
events AS (
  SELECT split, patient_id, hadm_id, 'diagnosis' AS domain, {cat('code')} AS token, 1.0::DOUBLE AS value FROM r_diagnoses
  UNION ALL SELECT split, patient_id, hadm_id, 'medication', {norm('drug')}, 1.0::DOUBLE FROM r_prescriptions
  UNION ALL SELECT split, patient_id, hadm_id, 'lab', {norm('item')}, value FROM r_labevents
  UNION ALL SELECT split, patient_id, hadm_id, 'icu', 'ICUStayDuration', los FROM r_icustays),
attached AS (
  SELECT e.split, e.patient_id, a.admit_ms, e.domain, e.token, e.value
  FROM events e JOIN r_admissions a ON e.patient_id = a.patient_id AND e.hadm_id = a.hadm_id),
feats AS (
  SELECT a.split, a.patient_id, a.admit_ms, v.feature_id, a.value FROM attached a JOIN vocab v ON a.token = v.token),
labels AS (
  SELECT p.split, p.patient_id, p.is_dead FROM r_patients p
  WHERE EXISTS (SELECT 1 FROM feats f WHERE f.split = p.split AND f.patient_id = p.patient_id)),
lf AS (
  SELECT f.* FROM feats f
  WHERE EXISTS (SELECT 1 FROM labels l WHERE l.split = f.split AND l.patient_id = f.patient_id)),
visit_idx AS (
  SELECT split, patient_id, admit_ms,
         row_number() OVER (PARTITION BY split, patient_id ORDER BY admit_ms) - 1 AS visit_index
  FROM (SELECT DISTINCT split, patient_id, admit_ms FROM lf)),
cells AS (
  SELECT c.split, c.patient_id, v.visit_index, c.admit_ms, c.feature_id, c.value
  FROM (SELECT split, patient_id, admit_ms, feature_id, sum(value) AS value FROM lf
        GROUP BY split, patient_id, admit_ms, feature_id) c
  JOIN visit_idx v ON c.split = v.split AND c.patient_id = v.patient_id AND c.admit_ms = v.admit_ms),
seq_entries AS (
  SELECT f.split, l.is_dead AS label, f.patient_id, v.visit_index,
         row_number() OVER (PARTITION BY f.split, f.patient_id, f.admit_ms ORDER BY f.feature_id, f.value) - 1 AS entry_index,
         f.feature_id, f.value
  FROM lf f
  JOIN visit_idx v ON f.split = v.split AND f.patient_id = v.patient_id AND f.admit_ms = v.admit_ms
  JOIN labels l ON f.split = l.split AND f.patient_id = l.patient_id),
seq_summary AS (
  SELECT split, label, patient_id,
         CAST(count(DISTINCT visit_index) AS BIGINT) AS n_visits,
         CAST(count(*) FILTER (WHERE visit_index = last_visit) AS BIGINT) AS last_visit_size,
         CAST(count(*) AS BIGINT) AS n_entries
  FROM (SELECT *, max(visit_index) OVER (PARTITION BY split, patient_id) AS last_visit FROM seq_entries)
  GROUP BY split, label, patient_id),
width AS (SELECT max(feature_id) + 1 AS w FROM vocab),
scores AS (
  SELECT split, patient_id, label, score, CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END AS prediction
  FROM (
    SELECT p.split, p.patient_id, l.is_dead AS label,
           (floor((1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.375::DOUBLE * p.n_visits + 0.03125::DOUBLE * p.n_distinct - 2.0::DOUBLE)))) * 1e6 + 0.5) / 1e6) AS score
    FROM (SELECT split, patient_id, count(DISTINCT admit_ms) AS n_visits, count(DISTINCT feature_id) AS n_distinct
          FROM lf GROUP BY split, patient_id) p
    JOIN labels l ON p.split = l.split AND p.patient_id = l.patient_id)),
score_groups AS (
  SELECT split, score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY split, score),
score_cum AS (
  SELECT split, score, pos, neg,
         sum(pos) OVER (PARTITION BY split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_cum,
         sum(neg) OVER (PARTITION BY split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum
  FROM score_groups),
score_tot AS (SELECT split, sum(pos) AS P, sum(neg) AS N FROM score_groups GROUP BY split),
cm AS (
  SELECT split,
         CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS c00,
         CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c01,
         CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS c10,
         CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c11
  FROM scores GROUP BY split)"""

LINEAR = """
linear AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)) AS score FROM (
    SELECT l.split, l.patient_id, l.is_dead AS label, e.epoch,
           floor((coalesce(s.total, 0.0::DOUBLE) * e.scale - 0.25::DOUBLE) * 1e6 + 0.5) / 1e6 AS logit
    FROM labels l
    CROSS JOIN (VALUES (0, 0.5::DOUBLE), (1, 1.0::DOUBLE), (2, 2.0::DOUBLE)) e(epoch, scale)
    LEFT JOIN (
      SELECT split, patient_id, sum(value * (((feature_id * 37) % 101 - 50) / 1000.0::DOUBLE)) AS total FROM cells GROUP BY split, patient_id) s
      ON l.split = s.split AND l.patient_id = s.patient_id))"""

# The valid split's raw rows scored as new patients: labs by the training maximum.
NEW_PATIENTS = f"""
n_labs AS (
  SELECT TRY_CAST(SUBJECT_ID AS BIGINT) AS patient_id, HADM_ID AS hadm_id, ITEMID AS item,
         VALUENUM / (SELECT NULLIF(max_value, 0) FROM lab_max WHERE split = 'train') AS value
  FROM labs_c
  WHERE split = 'valid' AND VALUENUM IS NOT NULL AND SUBJECT_ID <> '' AND HADM_ID <> '' AND ITEMID <> '' AND TRY_CAST(SUBJECT_ID AS BIGINT) IS NOT NULL),
n_events AS (
  SELECT patient_id, hadm_id, {cat('code')} AS token, 1.0::DOUBLE AS value FROM r_diagnoses WHERE split = 'valid'
  UNION ALL SELECT patient_id, hadm_id, {norm('drug')}, 1.0::DOUBLE FROM r_prescriptions WHERE split = 'valid'
  UNION ALL SELECT patient_id, hadm_id, {norm('item')}, value FROM n_labs WHERE value IS NOT NULL
  UNION ALL SELECT patient_id, hadm_id, 'ICUStayDuration', los FROM r_icustays WHERE split = 'valid'),
n_sums AS (
  SELECT e.patient_id, sum(e.value * (((v.feature_id * 37) % 101 - 50) / 1000.0::DOUBLE)) AS total
  FROM n_events e JOIN (SELECT * FROM r_admissions WHERE split = 'valid') a ON e.patient_id = a.patient_id AND e.hadm_id = a.hadm_id
  JOIN vocab v ON e.token = v.token GROUP BY e.patient_id),
n_scored AS (
  SELECT s.patient_id, CAST(p.is_dead AS INTEGER) AS label, floor((s.total - 0.25::DOUBLE) * 1e6 + 0.5) / 1e6 AS logit
  FROM n_sums s LEFT JOIN (SELECT DISTINCT patient_id, is_dead FROM r_patients WHERE split = 'valid') p ON s.patient_id = p.patient_id)"""

LINEAR_ONE = """
one AS (
  SELECT *, CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END AS prediction, least(greatest(score, 1e-15), 1.0::DOUBLE - 1e-15) AS p
  FROM linear WHERE epoch = 1)"""

CURVE = """
curve AS (
  SELECT CAST(epoch AS INTEGER) AS epoch, split AS phase, count(*) AS n,
         floor(avg(-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p))) * 1e9 + 0.5) / 1e9 AS loss,
         floor(avg(CASE WHEN label = (CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE * 1e9 + 0.5) / 1e9 AS accuracy
  FROM (SELECT *, least(greatest(score, 1e-15), 1.0::DOUBLE - 1e-15) AS p FROM linear WHERE split IN ('train', 'valid'))
  GROUP BY epoch, split)"""

def _adam(step: int, before: str, after: str, batch: str) -> str:
    """One mini-batch step: state ``before`` (feature_id, weight, m, v) to ``after``."""
    return f"""
{after}_res AS (
  SELECT b.patient_id, (1.0::DOUBLE / (1.0::DOUBLE + exp(-s.logit)) - b.label) / b.n AS r
  FROM (SELECT *, count(*) OVER () AS n FROM mb WHERE {batch}) b
  JOIN (SELECT c.patient_id, sum(c.value * w.weight) AS logit FROM mcells c JOIN {before} w USING (feature_id) GROUP BY c.patient_id) s USING (patient_id)),
{after}_g AS (
  SELECT w.feature_id, w.weight, w.m, w.v, coalesce(g.g, 0.0::DOUBLE) + 0.0004::DOUBLE * w.weight AS g
  FROM {before} w LEFT JOIN (SELECT c.feature_id, sum(r.r * c.value) AS g FROM mcells c JOIN {after}_res r USING (patient_id) GROUP BY c.feature_id) g USING (feature_id)),
{after}_mv AS (
  SELECT feature_id, weight, 0.9::DOUBLE * m + {1.0 - 0.9!r}::DOUBLE * g AS m, 0.999::DOUBLE * v + {1.0 - 0.999!r}::DOUBLE * g * g AS v FROM {after}_g),
{after} AS (
  SELECT feature_id, weight - 0.007::DOUBLE * (m / {1.0 - 0.9**step!r}::DOUBLE) / (sqrt(v / {1.0 - 0.999**step!r}::DOUBLE) + 1e-8) AS weight, m, v FROM {after}_mv)"""


# Training patients in batches, their pooled cells with the intercept's, the fixed start.
MINIBATCH = f"""
mb AS (
  SELECT patient_id, is_dead AS label, g // 64 AS batch_id
  FROM (SELECT *, row_number() OVER (ORDER BY {bucket('patient_id', 0)}, patient_id) - 1 AS g FROM labels WHERE split = 'train')),
mcells AS (
  SELECT c.patient_id, c.feature_id, sum(c.value) AS value FROM cells c JOIN mb USING (patient_id) WHERE c.split = 'train' GROUP BY c.patient_id, c.feature_id
  UNION ALL SELECT patient_id, -1, 1.0::DOUBLE FROM mb),
s0 AS (
  SELECT feature_id, ((feature_id * 37) % 101 - 50) / 1000.0::DOUBLE AS weight, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM vocab
  UNION ALL SELECT -1, -0.25::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE)"""


def _epoch_of(state: str, epoch: int) -> str:
    return f"""SELECT {epoch} AS epoch, count(*) AS n,
       floor(avg(-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p))) * 1e6 + 0.5) / 1e6 AS loss,
       floor(avg(CASE WHEN label = (CASE WHEN p > 0.5 THEN 1 ELSE 0 END) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE * 1e6 + 0.5) / 1e6 AS accuracy
FROM (SELECT b.label, least(greatest(1.0::DOUBLE / (1.0::DOUBLE + exp(-s.logit)), 1e-15), 1.0::DOUBLE - 1e-15) AS p
      FROM mb b JOIN (SELECT c.patient_id, sum(c.value * w.weight) AS logit FROM mcells c JOIN {state} w USING (feature_id) GROUP BY c.patient_id) s USING (patient_id))"""


def _decayed(age: str, half_life: str) -> str:
    """Pooled cells, each weighted by its visit's age."""
    return f"""SELECT split, patient_id, feature_id, floor((sum(value * power(2.0::DOUBLE, -({age}) / {half_life}::DOUBLE)) + 1e-9) * 1e6 + 0.5) / 1e6 AS value
FROM (SELECT *, max(visit_index) OVER w AS last_index, max(admit_ms) OVER w AS last_ms FROM cells WINDOW w AS (PARTITION BY split, patient_id))
GROUP BY split, patient_id, feature_id"""


# Columns of the raw tables.
RAW = {
    "admissions": ["SUBJECT_ID", "HADM_ID", "ADMITTIME"],
    "diagnoses": ["SUBJECT_ID", "HADM_ID", "ICD9_CODE"],
    "icustays": ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "LOS"],
    "labevents": ["SUBJECT_ID", "HADM_ID", "ITEMID", "VALUENUM"],
    "patients": ["SUBJECT_ID", "DOD_HOSP"],
    "prescriptions": ["SUBJECT_ID", "HADM_ID", "DRUG"],
}

EVENTS = f"""
ev AS (
  SELECT user_id AS patient_id, (CAST(ts AS DATE) - DATE '1970-01-01') * 86400000 AS admit_ms,
         {norm('event_type')} AS token, value
  FROM events),
etok AS (
  SELECT token, row_number() OVER (ORDER BY token) - 1 AS feature_id
  FROM (SELECT DISTINCT token FROM ev WHERE token IS NOT NULL)),
ef AS (SELECT e.patient_id, e.admit_ms, t.feature_id, e.value FROM ev e JOIN etok t ON e.token = t.token),
e_visit AS (
  SELECT patient_id, admit_ms, row_number() OVER (PARTITION BY patient_id ORDER BY admit_ms) - 1 AS visit_index
  FROM (SELECT DISTINCT patient_id, admit_ms FROM ef))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_BASE = (ROLES, PREP)
_REC = _BASE + (RECS,)
_DS = _REC + (VOCAB, DS)


def _q(parts, body: str) -> str:
    return _with(*parts) + body


def _batches(source: str, cols: str) -> str:
    return f"""(SELECT {cols}, g // {64} AS batch_id, g % {64} AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {bucket('patient_id', 0)}, patient_id) - 1 AS g FROM {source}))"""


ORACLE: dict[str, str] = {
    "prepared_admissions": _q(_BASE, "SELECT * FROM p_admissions"),
    "prepared_diagnoses": _q(_BASE, "SELECT * FROM p_diagnoses"),
    "prepared_icustays": _q(_BASE, "SELECT * FROM p_icustays"),
    "prepared_labevents": _q(_BASE, "SELECT * FROM p_labevents"),
    "prepared_patients": _q(_BASE, "SELECT * FROM p_patients"),
    "prepared_prescriptions": _q(_BASE, "SELECT * FROM p_prescriptions"),
    "cohort_split": _q(_BASE, "SELECT SUBJECT_ID, split FROM cohort_split"),
    "split_summary": _q(
        _BASE,
        """SELECT c.split, CAST(count(*) AS BIGINT) AS n_patients, m.max_value AS lab_max
FROM cohort_split c LEFT JOIN lab_max m ON c.split = m.split GROUP BY c.split, m.max_value""",
    ),
    "rejects": _q(
        _REC,
        """SELECT 'labevents' AS table_name, 'prepare' AS stage, split, SUBJECT_ID AS subject_id, HADM_ID AS hadm_id,
       CASE WHEN RAW_VALUE IS NULL THEN 'missing VALUENUM' ELSE 'bad VALUENUM' END AS reason
FROM labs_c WHERE VALUENUM IS NULL
"""
        + "".join(
            f"UNION ALL SELECT '{t}', 'records', split, raw_subject_id, raw_hadm_id, reason FROM v_{t} WHERE reason IS NOT NULL\n"
            for t in ("admissions", "diagnoses", "icustays", "labevents", "patients", "prescriptions")
        ),
    ),
    "admission_records": _q(_REC, "SELECT * FROM r_admissions"),
    "csv_front_door": _q(
        (ROLES,),
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, SUBJECT_ID AS subject_id, concat_ws('|', {', '.join(cs[1:])}) AS fields FROM raw_{t} "
            f"WHERE {hashed('SUBJECT_ID')} % 53 <> 0 AND " + " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in cs)
            for t, cs in RAW.items()
        ),
    ),
    "raw_scan": _q(
        (ROLES,),
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, SUBJECT_ID AS subject_id, concat_ws('|', " + ", ".join(f"NULLIF({c}, '')" for c in cs[1:]) + f") AS fields FROM raw_{t}"
            for t, cs in RAW.items()
        ),
    ),
    "ragged_rows": _q(
        (ROLES,),
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, 'read' AS stage, NULL::VARCHAR AS split, SUBJECT_ID AS subject_id, NULL::VARCHAR AS hadm_id, 'ragged row' AS reason, "
            + " || ',' || ".join(f"coalesce({c}, '')" for c in cs)
            + f" || ',extra' AS record FROM raw_{t} WHERE {hashed('SUBJECT_ID')} % 53 = 0"
            for t, cs in RAW.items()
        ),
    ),
    "ragged_counts": _q(
        (ROLES,),
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS written, count(*) FILTER (WHERE {hashed('SUBJECT_ID')} % 53 <> 0) AS kept, "
            f"count(*) FILTER (WHERE {hashed('SUBJECT_ID')} % 53 = 0) AS rejected FROM raw_{t}"
            for t in RAW
        ),
    ),
    "record_tables": _q(
        _REC,
        """SELECT 'admissions' AS table_name, split, patient_id, concat_ws('|', hadm_id, CAST(admit_ms AS VARCHAR)) AS fields, NULL::DOUBLE AS number FROM r_admissions
UNION ALL SELECT 'diagnoses', split, patient_id, concat_ws('|', hadm_id, code), NULL FROM r_diagnoses
UNION ALL SELECT 'icustays', split, patient_id, concat_ws('|', hadm_id, icustay_id), floor(los * 1e9 + 0.5) / 1e9 FROM r_icustays
UNION ALL SELECT 'labevents', split, patient_id, concat_ws('|', hadm_id, item), floor(value * 1e9 + 0.5) / 1e9 FROM r_labevents
UNION ALL SELECT 'patients', split, patient_id, CAST(is_dead AS VARCHAR), NULL FROM r_patients
UNION ALL SELECT 'prescriptions', split, patient_id, concat_ws('|', hadm_id, drug), NULL FROM r_prescriptions""",
    ),
    "split_file_records": _q(
        _REC,
        """SELECT 'admissions' AS table_name, split, patient_id, concat_ws('|', hadm_id, CAST(admit_ms AS VARCHAR)) AS fields, NULL::DOUBLE AS number FROM r_admissions
UNION ALL SELECT 'diagnoses', split, patient_id, concat_ws('|', hadm_id, code), NULL FROM r_diagnoses
UNION ALL SELECT 'icustays', split, patient_id, concat_ws('|', hadm_id, icustay_id), floor(los * 1e9 + 0.5) / 1e9 FROM r_icustays
UNION ALL SELECT 'labevents', split, patient_id, concat_ws('|', hadm_id, item), floor(value * 1e9 + 0.5) / 1e9 FROM r_labevents
UNION ALL SELECT 'patients', split, patient_id, CAST(is_dead AS VARCHAR), NULL FROM r_patients
UNION ALL SELECT 'prescriptions', split, patient_id, concat_ws('|', hadm_id, drug), NULL FROM r_prescriptions""",
    ),
    "prepared_round_trip": _q(
        _REC,
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, split, count(*) AS n, count(DISTINCT patient_id) AS n_patients FROM r_{t} GROUP BY split" for t in RAW
        ),
    ),
    "sorted_sink": _q(
        _DS,
        """SELECT 'featureDF_train' AS data_set, count(*) AS n_rows, 0::BIGINT AS rows_out_of_order, 0::BIGINT AS parts_out_of_order FROM lf WHERE split = 'train'
UNION ALL SELECT 'patientIDLabels_train', count(*), 0, 0 FROM labels WHERE split = 'train'""",
    ),
    "sorted_sinks": _q(
        _DS,
        "\nUNION ALL ".join(
            f"""SELECT 'featureDF_{x}' AS data_set, count(*) AS n_rows, 0::BIGINT AS rows_out_of_order, 0::BIGINT AS parts_out_of_order FROM lf WHERE split = '{x}'
UNION ALL SELECT 'patientIDLabels_{x}', count(*), 0, 0 FROM labels WHERE split = '{x}'"""
            for x in ("test", "valid")
        ),
    ),
    "sequences_round_trip": _q(
        _DS,
        """SELECT 'all' AS written, split, patient_id, label, n_visits, n_entries FROM seq_summary
UNION ALL SELECT 'one', split, patient_id, label, n_visits, n_entries FROM seq_summary WHERE split = 'test'""",
    ),
    "patient_vector_cells": _q(
        _DS,
        """SELECT l.split, l.patient_id, l.is_dead AS label, p.feature_id, floor(p.value * 1e9 + 0.5) / 1e9 AS value
FROM labels l LEFT JOIN (SELECT split, patient_id, feature_id, sum(value) AS value FROM cells GROUP BY split, patient_id, feature_id HAVING sum(value) <> 0) p
  ON l.split = p.split AND l.patient_id = p.patient_id""",
    ),
    "linear_predictions": _q(
        _DS + (LINEAR,),
        "SELECT split, patient_id, label, logit, floor(score * 1e9 + 0.5) / 1e9 AS score, CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END AS prediction FROM linear WHERE epoch = 1",
    ),
    "linear_report": _q(
        _DS + (LINEAR, LINEAR_ONE),
        """SELECT split, 'accuracy' AS metric, floor(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE * 1e9 + 0.5) / 1e9 AS value FROM one GROUP BY split
UNION ALL SELECT split, 'log_loss', floor(avg(-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p))) * 1e9 + 0.5) / 1e9 FROM one GROUP BY split
UNION ALL SELECT a.split, 'auc', floor((sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) / count(*)) * 1e9 + 0.5) / 1e9
  FROM one a JOIN one b ON a.split = b.split AND a.label = 1 AND b.label = 0 GROUP BY a.split
UNION ALL SELECT s.split, 'cell_' || t.l || q.p, CAST(count(o.label) AS DOUBLE)
  FROM (SELECT DISTINCT split FROM one) s CROSS JOIN (VALUES (0), (1)) t(l) CROSS JOIN (VALUES (0), (1)) q(p)
  LEFT JOIN one o ON o.split = s.split AND o.label = t.l AND o.prediction = q.p GROUP BY s.split, t.l, q.p""",
    ),
    "bundle_round_trip": _q(
        _DS + (LINEAR,),
        """SELECT split, patient_id, label, logit, floor(score * 1e9 + 0.5) / 1e9 AS score, CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END AS prediction,
       TRUE AS same_after_load FROM linear WHERE epoch = 1 AND split = 'test'""",
    ),
    "bundle_evaluation": _q(
        _DS + (LINEAR, LINEAR_ONE),
        """SELECT split, count(*) AS n,
       floor(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE * 1e9 + 0.5) / 1e9 AS accuracy,
       floor(avg(-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p))) * 1e9 + 0.5) / 1e9 AS log_loss
FROM one GROUP BY split""",
    ),
    "new_patient_scores": _q(
        _DS + (NEW_PATIENTS,),
        """SELECT patient_id, label, logit, floor(score * 1e9 + 0.5) / 1e9 AS score, CASE WHEN score > 1.0::DOUBLE - score THEN 1 ELSE 0 END AS prediction
FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)) AS score FROM n_scored)""",
    ),
    "learning_curve": _q(_DS + (LINEAR, CURVE), "SELECT epoch, phase, n, loss, accuracy FROM curve"),
    "best_epoch": _q(
        _DS + (LINEAR, CURVE), "SELECT epoch, accuracy FROM curve WHERE phase = 'valid' AND accuracy > 0 ORDER BY accuracy DESC, epoch LIMIT 1"
    ),
    "run_model_check": _q(
        _DS,
        """SELECT split, count(*) AS n_scored, 4::BIGINT AS curve_rows, TRUE AS first_best_epoch, TRUE AS finite_losses, TRUE AS report_agrees
FROM labels WHERE split = 'test' GROUP BY split""",
    ),
    "model_fit_check": _q(
        _DS,
        """SELECT (SELECT count(*) FROM labels WHERE split = 'train') AS n_train, (SELECT count(*) FROM labels) AS n_scored,
       (SELECT CAST(w AS BIGINT) FROM width) AS width, TRUE AS at_optimum, TRUE AS same_scores""",
    ),
    "vocabulary": _q(_REC + (VOCAB,), "SELECT token, feature_id, domain FROM vocab"),
    "vocabulary_sizes": _q(
        _REC + (VOCAB,),
        """SELECT domain, domain_rank, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(min(feature_id) AS BIGINT) AS first_id, CAST(max(feature_id) AS BIGINT) AS last_id
FROM entries GROUP BY domain, domain_rank""",
    ),
    "indexed_features": _q(_DS, "SELECT * FROM lf"),
    "salted_features": _q(_DS, "SELECT * FROM lf"),
    "by_patient_join": _q(
        _DS,
        """SELECT l.split, l.patient_id, CAST(l.is_dead AS INTEGER) AS label, count(*) AS n_rows, count(DISTINCT f.admit_ms) AS n_visits
FROM labels l JOIN lf f ON l.split = f.split AND l.patient_id = f.patient_id GROUP BY l.split, l.patient_id, l.is_dead""",
    ),
    "unknown_tokens": _q(
        _DS,
        """SELECT split, domain, token, CAST(count(*) AS BIGINT) AS n_events FROM attached a
WHERE NOT EXISTS (SELECT 1 FROM vocab v WHERE v.token = a.token) GROUP BY split, domain, token""",
    ),
    "dataset_labels": _q(_DS, "SELECT * FROM labels"),
    "features_round_trip": _q(_DS, "SELECT split, patient_id, admit_ms, feature_id, value, CAST(is_dead AS INTEGER) AS is_dead FROM lf JOIN labels USING (split, patient_id)"),
    "num_features": _q(_DS, "SELECT CAST(max(feature_id) + 1 AS BIGINT) AS num_features FROM lf WHERE split = 'train'"),
    "visit_cells": _q(
        _DS, "SELECT split, patient_id, visit_index, admit_ms, feature_id, (floor((value) * 1e9 + 0.5) / 1e9) AS value FROM cells"
    ),
    "sequence_entries": _q(_DS, "SELECT * FROM seq_entries"),
    "hot_visit_entries": _q(_DS, "SELECT * FROM seq_entries"),
    "sequence_summary": _q(_DS, "SELECT * FROM seq_summary"),
    "padded_batches": _q(
        _DS
        + (
            f"""
slots AS (
  SELECT split, batch_id, position, row_number() OVER (PARTITION BY split, batch_id ORDER BY length DESC, position) - 1 AS slot,
         patient_id, label, length, max(length) OVER (PARTITION BY split, batch_id) AS padded_length
  FROM {_batches('(SELECT split, patient_id, label, n_visits AS length FROM seq_summary)', 'split, patient_id, label, length')})""",
        ),
        """SELECT s.*, e.visit_index AS step, e.entry_index, e.feature_id, e.value
FROM slots s JOIN seq_entries e ON s.split = e.split AND s.patient_id = e.patient_id
UNION ALL
SELECT *, unnest(generate_series(length, padded_length - 1)) AS step, 0, NULL, 0.0::DOUBLE FROM slots WHERE padded_length > length""",
    ),
    "shuffled_rows": _q(
        _DS,
        f"""SELECT split, patient_id,
       row_number() OVER (ORDER BY split, {bucket('patient_id', 0)}, patient_id) - 1 AS shuffle_rank
FROM labels""",
    ),
    "pooled_sum": _q(
        _DS,
        "SELECT split, patient_id, feature_id, (floor((sum(value)) * 1e9 + 0.5) / 1e9) AS value FROM cells GROUP BY split, patient_id, feature_id",
    ),
    "pooled_mean": _q(
        _DS,
        """SELECT c.split, c.patient_id, c.feature_id, (floor(sum(c.value) * 1e9 + 0.5) / 1e9) / max(n.n) AS value
FROM cells c JOIN (SELECT split, patient_id, count(DISTINCT visit_index) AS n FROM cells GROUP BY split, patient_id) n
  ON c.split = n.split AND c.patient_id = n.patient_id
GROUP BY c.split, c.patient_id, c.feature_id""",
    ),
    "pooled_last": _q(
        _DS,
        """SELECT split, patient_id, feature_id, (floor((value) * 1e9 + 0.5) / 1e9) AS value FROM (
  SELECT *, max(visit_index) OVER (PARTITION BY split, patient_id) AS last_visit FROM cells)
WHERE visit_index = last_visit""",
    ),
    "pooled_decay": _q(_DS, _decayed("last_index - visit_index", "2.0")),
    "pooled_decay_days": _q(_DS, _decayed("(last_ms - admit_ms) / 86400000.0::DOUBLE", "30.0")),
    "minibatch_steps": _q(
        _DS + (MINIBATCH, _adam(1, "s0", "s1", "batch_id = 0"), _adam(2, "s1", "s2", "batch_id = 1")),
        "SELECT feature_id, floor(weight * 1e6 + 0.5) / 1e6 AS weight, floor(m * 1e6 + 0.5) / 1e6 AS m FROM s2",
    ),
    "minibatch_curve": _q(_DS + (MINIBATCH, _adam(1, "s0", "s1", "TRUE")), _epoch_of("s0", 0) + "\nUNION ALL\n" + _epoch_of("s1", 1)),
    "visit_vectors": _q(
        _DS,
        """SELECT split, patient_id, visit_index, CAST((SELECT w FROM width) AS BIGINT) AS width,
       CAST(count(*) FILTER (WHERE value <> 0) AS BIGINT) AS nnz, (floor((sum(value)) * 1e9 + 0.5) / 1e9) AS total
FROM cells GROUP BY split, patient_id, visit_index""",
    ),
    "rule_scores": _q(_DS, "SELECT * FROM scores"),
    "metric_summary": _q(
        _DS,
        """SELECT split, CAST(count(*) AS BIGINT) AS n,
       (floor((avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE) * 1e9 + 0.5) / 1e9) AS accuracy,
       (floor((avg(-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p)))) * 1e9 + 0.5) / 1e9) AS log_loss
FROM (SELECT *, least(greatest(score, 1e-15), 1.0::DOUBLE - 1e-15) AS p FROM scores) GROUP BY split""",
    ),
    "confusion_matrix": _q(
        _DS,
        """SELECT split, label, prediction, n,
       (floor((n / NULLIF(sum(n) OVER (PARTITION BY split, label), 0)) * 1e9 + 0.5) / 1e9) AS rate
FROM (
  SELECT split, 0 AS label, 0 AS prediction, c00 AS n FROM cm
  UNION ALL SELECT split, 0, 1, c01 FROM cm
  UNION ALL SELECT split, 1, 0, c10 FROM cm
  UNION ALL SELECT split, 1, 1, c11 FROM cm)""",
    ),
    "roc_curve": _q(
        _DS,
        """SELECT split, 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM score_tot
UNION ALL
SELECT c.split, c.score AS threshold, (floor((c.neg_cum / NULLIF(t.N, 0)) * 1e9 + 0.5) / 1e9) AS fpr, (floor((c.pos_cum / NULLIF(t.P, 0)) * 1e9 + 0.5) / 1e9) AS tpr
FROM score_cum c JOIN score_tot t ON c.split = t.split""",
    ),
    "roc_curve_turns": _q(
        _DS,
        """SELECT split, 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM score_tot
UNION ALL
SELECT split, score AS threshold,
       (floor((neg_cum / NULLIF(N, 0)) * 1e9 + 0.5) / 1e9) AS fpr,
       (floor((pos_cum / NULLIF(P, 0)) * 1e9 + 0.5) / 1e9) AS tpr
FROM (
  SELECT c.split, c.score, c.pos_cum, c.neg_cum, t.P, t.N,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY c.split) AS k,
         lag(c.neg_cum) OVER w AS pn, lead(c.neg_cum) OVER w AS nn,
         lag(c.pos_cum) OVER w AS pp, lead(c.pos_cum) OVER w AS np
  FROM score_cum c JOIN score_tot t ON c.split = t.split
  WINDOW w AS (PARTITION BY c.split ORDER BY c.score DESC))
WHERE i = 1 OR i = k OR nn - 2 * neg_cum + pn <> 0 OR np - 2 * pos_cum + pp <> 0""",
    ),
    "roc_auc": _q(
        _DS,
        """SELECT split,
       (floor((sum(neg * ((pos_cum - pos) + pos / 2.0::DOUBLE)) / NULLIF(sum(pos) * sum(neg), 0)) * 1e9 + 0.5) / 1e9) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM score_cum GROUP BY split""",
    ),
    "roc_bounded": _q(
        _DS,
        "SELECT split, TRUE AS thresholds_are_scores, TRUE AS bounded, TRUE AS rates_within_error, TRUE AS area_within_error FROM score_tot",
    ),
    "batch_weighted_accuracy": _q(
        _DS,
        f"""SELECT split, (floor((sum(accuracy * n) / sum(n)) * 1e9 + 0.5) / 1e9) AS mean, CAST(sum(n) AS BIGINT) AS count
FROM (SELECT split, batch_id, count(*) AS n,
             avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE AS accuracy
      FROM {_batches('scores', 'split, patient_id, label, prediction')} GROUP BY split, batch_id)
GROUP BY split""",
    ),
    "event_visit_cells": _q(
        (EVENTS,),
        """SELECT c.patient_id, v.visit_index, c.admit_ms, c.feature_id, (floor((c.value) * 1e9 + 0.5) / 1e9) AS value
FROM (SELECT patient_id, admit_ms, feature_id, sum(value) AS value FROM ef GROUP BY patient_id, admit_ms, feature_id) c
JOIN e_visit v ON c.patient_id = v.patient_id AND c.admit_ms = v.admit_ms""",
    ),
    "event_sequence_entries": _q(
        (EVENTS,),
        """SELECT f.patient_id, v.visit_index,
       row_number() OVER (PARTITION BY f.patient_id, f.admit_ms ORDER BY f.feature_id, f.value) - 1 AS entry_index,
       f.feature_id, f.value
FROM ef f JOIN e_visit v ON f.patient_id = v.patient_id AND f.admit_ms = v.admit_ms""",
    ),
}

#: The array form holds the same entries.
ORACLE["padded_arrays"] = ORACLE["padded_batches"]
