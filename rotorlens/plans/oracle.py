"""The same queries as SQL over the given tables, for checking."""

from __future__ import annotations

from rotorlens.functions.labels import short_text
from rotorlens.schema import (
    EDA_EPS,
    EDA_TEMP,
    EPS,
    FAULT_LABELS,
    LABEL_TRANSLATION,
    MODEL_INPUTS,
    NORMAL_ALERT_LABEL,
    NORMAL_DESCRIPTION,
    SPECTRAL_FEATURES,
    UNKNOWN_ALERT_LABEL,
)

SPECTRA = """spectra AS (
  SELECT e.event_id, CAST(e.event_id AS VARCHAR) AS record_id, 'dev-' || (e.user_id % 3) AS dev_eui,
         CAST(1 + e.event_id % 4 AS DOUBLE) AS mode, CAST(1 + e.user_id % 4 AS DOUBLE) AS axis,
         CAST(floor(epoch_us(e.ts) / 1000) AS DOUBLE) AS ts_ms, e.value AS temp,
         list_transform(range(64), lambda i: CAST(i AS DOUBLE) * CAST(1.5 AS DOUBLE)) AS freqs,
         list_transform(v.embedding, lambda x: abs(CAST(x AS DOUBLE)) * (1 + e.value / 100)) AS vals,
         CAST(v.label % 4 AS INTEGER) AS true_label
  FROM events e JOIN embeddings v ON v.vec_id = e.event_id % (SELECT count(*) FROM embeddings))"""


def _features(eps: float = EPS, temp: str = "temp", source: str = "spectra", name: str = "features") -> str:
    return f"""{name}_sums AS (
  SELECT *, list_sum(list_transform(vals, lambda x: x * x)) AS energy,
    list_sum(list_transform(range(1, len(vals) + 1), lambda i: CASE WHEN freqs[i] < 30 THEN vals[i] * vals[i] ELSE 0.0::DOUBLE END)) AS energy_low,
    list_sum(list_transform(range(1, len(vals) + 1), lambda i: CASE WHEN freqs[i] >= 30 AND freqs[i] < 70 THEN vals[i] * vals[i] ELSE 0.0::DOUBLE END)) AS energy_mid,
    list_sum(list_transform(range(1, len(vals) + 1), lambda i: CASE WHEN freqs[i] >= 70 THEN vals[i] * vals[i] ELSE 0.0::DOUBLE END)) AS energy_high,
    list_sum(vals) / len(vals) AS mean_amplitude, list_max(vals) AS max_amplitude, list_min(vals) AS min_amplitude,
    freqs[list_position(vals, list_max(vals))] AS dominant_frequency
  FROM {source}),
{name} AS (
  SELECT * REPLACE ({temp} AS temp), sqrt(energy / len(vals)) AS rms,
    sqrt(list_sum(list_transform(vals, lambda x: (x - mean_amplitude) * (x - mean_amplitude))) / len(vals)) AS std_amplitude,
    max_amplitude - min_amplitude AS peak_to_peak,
    max_amplitude / (sqrt(energy / len(vals)) + CAST({eps!r} AS DOUBLE)) AS crest_factor,
    energy_low / (energy + CAST({eps!r} AS DOUBLE)) AS ratio_low,
    energy_mid / (energy + CAST({eps!r} AS DOUBLE)) AS ratio_mid,
    energy_high / (energy + CAST({eps!r} AS DOUBLE)) AS ratio_high
  FROM {name}_sums)"""


def _case(key: str, mapping: dict, default: str) -> str:
    def text(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {default} END"


DESCRIBED = _case("fault_type", FAULT_LABELS, f"'{NORMAL_DESCRIPTION}'")
ALERT_LABEL = _case("fault_type", {**FAULT_LABELS, -1: NORMAL_ALERT_LABEL}, f"'{UNKNOWN_ALERT_LABEL}'")
AXIS = "CASE axis WHEN 1 THEN 'X' WHEN 2 THEN 'Y' WHEN 3 THEN 'Z' ELSE CAST(axis AS VARCHAR) END"
SEVERITY = ("CASE WHEN NOT is_anomaly THEN 'NONE' WHEN confidence >= 0.5 THEN 'HIGH' "
            "WHEN confidence >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END")
RANK = "CASE severity_level WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END"


def _short(label: str) -> str:
    last = f"list_last(string_split({label}, ' - '))"
    return (f"CASE WHEN contains({label}, ' - ') THEN upper(substr({last}, 1, 1)) || lower(substr({last}, 2)) "
            f"ELSE {label} END")


def _scored(source: str) -> str:
    """Stand-in predictions and labels on top of ``source``."""
    return f"""pseudo AS (
  SELECT *, CAST(-0.3 AS DOUBLE) - CAST(0.4 AS DOUBLE) * ((event_id * 7919) % 1000) / CAST(1000 AS DOUBLE) AS anomaly_score,
    (event_id * 7919) % 1000 >= 800 AS is_anomaly,
    CAST(CASE WHEN (event_id * 7919) % 1000 >= 800 THEN (event_id * 31) % 4 ELSE -1 END AS INTEGER) AS fault_type,
    CASE WHEN (event_id * 7919) % 1000 >= 800
         THEN round(CAST(0.25 AS DOUBLE) + CAST(0.0007 AS DOUBLE) * ((event_id * 104729) % 1000), 4)
         ELSE CAST(0 AS DOUBLE) END AS confidence
  FROM {source}),
scored AS (SELECT *, {DESCRIBED} AS fault_label, {SEVERITY} AS severity_level FROM pseudo)"""


EVENTS = "base AS (SELECT event_id, CAST(event_id AS VARCHAR) AS record_id FROM events)"
TRANSLATED = _case("fault_label", LABEL_TRANSLATION, "fault_label")
ALERTS = f"""alerts AS (
  SELECT * REPLACE ({TRANSLATED} AS fault_label), {AXIS} AS axis_label, make_timestamp(CAST(ts_ms AS BIGINT) * 1000) AS ts
  FROM scored WHERE is_anomaly)"""

ON_EVENTS = f"WITH {EVENTS}, {_scored('base')}"
ON_SPECTRA = f"WITH {SPECTRA}, {_scored('spectra')}, {ALERTS}"
ON_FEATURES = f"WITH {SPECTRA}, {_features()}, {_scored('features')}, {ALERTS}"
FEATURES = f"WITH {SPECTRA}, {_features()}"


def _round(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0::DOUBLE AS {c}" for c in columns)


# Lines without damage that costs the record.
VALID = "event_id % 50 NOT IN (3, 7, 11, 13, 17, 19, 23, 29, 43, 45, 47)"
PARSED = f"""parsed AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 = 41 THEN 'unknown' ELSE dev_eui END AS dev_eui,
                    CASE WHEN event_id % 50 = 37 THEN -1 ELSE mode END AS mode,
                    CASE WHEN event_id % 50 = 37 THEN -1 ELSE axis END AS axis)
  FROM spectra WHERE {VALID})"""

_HARMONIC = ("coalesce(list_sum(list_transform(range(1, len(vals) + 1), lambda i: CASE WHEN "
             "abs(freqs[i] - {c}) <= {c} * CAST(0.05 AS DOUBLE) THEN vals[i] * vals[i] ELSE 0.0::DOUBLE END)), 0)")


def _harmonic(k: int) -> str:
    return _HARMONIC.format(c=f"(CAST(10.5 AS DOUBLE) * {k})")


SERIES = "PARTITION BY dev_eui, mode, axis"
TIE = "md5('42:' || record_id)"
PERSISTENT = (f"(is_anomaly AND sum(CAST(is_anomaly AS INTEGER)) OVER ({SERIES} ORDER BY ts_ms, {TIE}, record_id "
              f"ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) >= 2)")

ORACLE: dict[str, str] = {
    "raw_features_by_device": f"""WITH {SPECTRA}, {PARSED}, {_features(source='parsed')}
        SELECT dev_eui, count(*) AS records, round(avg(rms), 6) AS mean_rms, round(max(crest_factor), 6) AS max_crest
        FROM features GROUP BY dev_eui""",
    "ingest_valid": f"""WITH {SPECTRA}, {PARSED}
        SELECT dev_eui, mode, axis, ts_ms, temp, CAST(len(vals) AS INTEGER) AS points,
               round(list_sum(list_transform(vals, lambda x: x * x)), 6) AS energy FROM parsed""",
    "repeated_lines": f"""WITH {SPECTRA}, {PARSED}
        SELECT dev_eui, CAST(sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n,
               CAST(sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS ids FROM parsed GROUP BY dev_eui""",
    "ingest_discards": """SELECT CASE event_id % 50 WHEN 3 THEN 'malformed' WHEN 7 THEN 'malformed' WHEN 43 THEN 'malformed' WHEN 45 THEN 'malformed' WHEN 47 THEN 'malformed'
          WHEN 11 THEN 'no_item' WHEN 13 THEN 'no_readings' WHEN 17 THEN 'empty_list' WHEN 19 THEN 'no_values'
          WHEN 23 THEN 'bad_metadata' WHEN 29 THEN 'misaligned' ELSE 'valid' END AS outcome, count(*) AS n
        FROM events GROUP BY outcome""",
    "ingest_pairwise": """SELECT CAST(CASE WHEN event_id % 50 = 29 THEN 63 ELSE 64 END AS INTEGER) AS points, count(*) AS n
        FROM events WHERE event_id % 50 NOT IN (3, 7, 11, 13, 17, 19, 23, 43, 45, 47) GROUP BY points""",
    # Missing values count as 0 here, and metadata is not looked at.
    "ingest_lenient": f"""WITH {SPECTRA} SELECT CAST(len(vals) AS INTEGER) AS points,
          CASE WHEN event_id % 50 = 19 THEN CAST(0 AS DOUBLE)
               ELSE round(list_sum(list_transform(vals, lambda x: x * x)), 6) END AS energy
        FROM spectra WHERE event_id % 50 NOT IN (3, 7, 11, 13, 17, 29, 43, 47)""",
    "features_all": f"{FEATURES} SELECT record_id, dev_eui, mode, axis, ts_ms, {_round(*SPECTRAL_FEATURES)} FROM features",
    "features_eda": f"""WITH {SPECTRA}, {_features(EDA_EPS, f'CAST({EDA_TEMP} AS DOUBLE)')}
        SELECT record_id, {_round(*SPECTRAL_FEATURES)} FROM features""",
    "features_scrub": f"""{FEATURES} SELECT record_id,
          CASE WHEN event_id % 9 IN (1, 2) THEN 0 ELSE round(rms, 6) END AS rms,
          CASE WHEN event_id % 9 IN (3, 4) THEN 0 ELSE round(temp, 6) END AS temp,
          CASE WHEN event_id % 9 IN (1, 2) THEN 0 ELSE round(ratio_low, 6) END AS ratio_low,
          CASE WHEN event_id % 9 IN (1, 2) THEN 0 ELSE round(crest_factor, 6) END AS crest_factor,
          CASE WHEN event_id % 9 IN (1, 2) THEN 0 ELSE round(peak_to_peak, 6) END AS peak_to_peak,
          CASE WHEN event_id % 9 IN (1, 2) THEN 0 ELSE round(dominant_frequency, 6) END AS dominant_frequency
        FROM features""",
    "label_columns": f"""{ON_SPECTRA} SELECT record_id, make_timestamp(CAST(ts_ms AS BIGINT) * 1000) AS timestamp,
          {AXIS} AS axis_label, CAST(CAST(mode AS INTEGER) AS VARCHAR) AS mode_label, fault_label AS fault_description,
          {ALERT_LABEL} AS alert_label, {TRANSLATED} AS translated, {_short('fault_label')} AS short FROM scored""",
    "dominant_peak": f"""WITH {SPECTRA} SELECT record_id, round(freqs[list_position(vals, list_max(vals))], 6) AS freq,
          round(list_max(vals), 6) AS amplitude FROM spectra""",
    "harmonic_energy": f"""WITH {SPECTRA} SELECT record_id, round({_harmonic(1)}, 6) AS h1, round({_harmonic(2)}, 6) AS h2,
          round({_harmonic(3)}, 6) AS h3 FROM spectra""",
    "rule_diagnosis": f"""WITH {SPECTRA}, {_features()},
        shares AS (SELECT record_id, ratio_high, [h / (energy + CAST(1e-8 AS DOUBLE)) for h in
          [{', '.join(_harmonic(k) for k in range(1, 6))}]] AS s FROM features)
        SELECT record_id, CASE WHEN ratio_high >= 0.5 THEN 'bearing'
          WHEN len(list_filter(s, lambda x: x >= 0.05)) >= 3 THEN 'looseness'
          WHEN s[1] >= 0.02 AND s[1] >= s[2] THEN 'imbalance' WHEN s[2] >= 0.02 THEN 'misalignment'
          ELSE 'undetermined' END AS diagnosis FROM shares""",
    "temp_range": "SELECT CAST(event_id AS VARCHAR) AS record_id, value AS temp FROM events WHERE value BETWEEN -40 AND 150",
    "min_group": f"""WITH {SPECTRA} SELECT record_id, dev_eui, mode, axis FROM spectra
        QUALIFY count(*) OVER ({SERIES}) >= 210""",
    "group_sample_cap": f"""WITH {SPECTRA} SELECT record_id, dev_eui FROM spectra
        QUALIFY row_number() OVER (PARTITION BY dev_eui ORDER BY {TIE}, record_id) <= 1000""",
    "hash_sample": f"""WITH {SPECTRA} SELECT record_id, dev_eui FROM spectra ORDER BY {TIE}, record_id LIMIT 1000""",
    "numbered_copies": """WITH ids AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'hot'
          ELSE CAST(event_id % 97 AS VARCHAR) END AS id FROM events),
        numbered AS (SELECT id, row_number() OVER (PARTITION BY id) AS n FROM ids)
        SELECT CASE WHEN n = 1 THEN id ELSE id || '#' || n END AS record_id FROM numbered""",
    "example_records": f"""WITH {EVENTS}
        (SELECT record_id, 'one' AS pick FROM base ORDER BY md5('1:' || record_id), record_id LIMIT 1) UNION ALL
        (SELECT record_id, 'four' AS pick FROM base ORDER BY md5('2:' || record_id), record_id LIMIT 4) UNION ALL
        (SELECT record_id, 'first' AS pick FROM base ORDER BY record_id LIMIT 5)""",
    "pred_jsonl_flatten": f"""{ON_EVENTS} SELECT record_id, is_anomaly, fault_type, confidence FROM scored
        WHERE event_id % 7 <> 0 UNION ALL
        SELECT record_id, is_anomaly, fault_type, confidence FROM scored WHERE event_id % 7 <> 0 AND event_id % 2 = 0""",
    "features_join_predictions": f"""{ON_FEATURES}
        SELECT record_id, CASE WHEN event_id % 13 <> 0 THEN dev_eui END AS dev_eui,
          CASE WHEN event_id % 13 <> 0 THEN round(rms, 6) END AS rms,
          CASE WHEN event_id % 11 <> 0 THEN is_anomaly END AS is_anomaly,
          CASE WHEN event_id % 11 <> 0 THEN fault_type END AS fault_type
        FROM scored WHERE event_id % 13 <> 0 OR event_id % 11 <> 0""",
    "metadata_first": f"""{ON_SPECTRA} SELECT record_id, dev_eui, mode, axis, ts_ms, is_anomaly, fault_label,
          severity_level FROM scored""",
    "alerts_left_meta": f"""{ON_SPECTRA} SELECT record_id, is_anomaly, fault_type, confidence, {ALERT_LABEL} AS fault_label,
          severity_level, {', '.join(f'CASE WHEN event_id % 11 <> 0 THEN {c} END AS {c}' for c in ('dev_eui', 'mode', 'axis', 'ts_ms'))}
        FROM scored""",
    "label_dimension": f"""{ON_EVENTS}, coded AS (SELECT record_id,
          CAST(CASE WHEN event_id % 17 = 0 THEN 9 ELSE fault_type END AS INTEGER) AS fault_type FROM scored)
        SELECT record_id, fault_type, {ALERT_LABEL} AS fault_label FROM coded""",
    "severity_confidence": f"{ON_EVENTS} SELECT record_id, fault_label, confidence, severity_level FROM scored",
    "severity_crest": f"""{ON_FEATURES}, q AS (SELECT quantile_cont(crest_factor, 0.5) AS q50,
          quantile_cont(crest_factor, 0.8) AS q80 FROM scored WHERE is_anomaly)
        SELECT record_id, CASE WHEN crest_factor >= q80 THEN 'HIGH' WHEN crest_factor >= q50 THEN 'MEDIUM' ELSE 'LOW' END
          AS severity_crest FROM scored, q WHERE is_anomaly""",
    "quantiles_crest": f"""{ON_FEATURES} SELECT round(quantile_cont(crest_factor, 0.5), 6) AS q50,
          round(quantile_cont(crest_factor, 0.8), 6) AS q80 FROM scored WHERE is_anomaly""",
    "alerts_filtered": f"""{ON_SPECTRA} SELECT record_id, fault_label, severity_level FROM alerts
        WHERE severity_level IN ('HIGH', 'MEDIUM') AND fault_type IN (0, 2)""",
    "report_table": f"""{ON_SPECTRA} SELECT ts AS "Timestamp", dev_eui AS "Dispositiu", axis_label AS "Eix",
          CAST(CAST(mode AS INTEGER) AS VARCHAR) AS "Mode", fault_label AS "Tipus de Fallo",
          severity_level AS "Severitat" FROM alerts""",
    "kpi_row": f"""{ON_SPECTRA} SELECT count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies,
          count(*) FILTER (severity_level = 'HIGH') AS high, count(*) FILTER (severity_level = 'MEDIUM') AS medium,
          count(*) FILTER (severity_level = 'LOW') AS low,
          count(DISTINCT dev_eui) FILTER (is_anomaly) AS devices, count(DISTINCT fault_label) FILTER (is_anomaly) AS fault_types,
          round(100.0::DOUBLE * count(*) FILTER (is_anomaly) / count(*), 6) AS pct_anomalies,
          count(*) FILTER (NOT is_anomaly) AS normals,
          round(100 - 100.0::DOUBLE * count(*) FILTER (is_anomaly) / count(*), 6) AS pct_normals FROM scored""",
    "anomaly_rate": f"""{ON_EVENTS} SELECT count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies,
          count(*) FILTER (NOT is_anomaly) AS normals,
          round(100.0::DOUBLE * count(*) FILTER (is_anomaly) / count(*), 6) AS pct_anomalies FROM scored""",
    "fault_distribution": f"""{ON_EVENTS}, codes AS (SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS fault_type)
        SELECT c.fault_type, {_case('c.fault_type', FAULT_LABELS, 'NULL')} AS fault_label, count(s.record_id) AS n,
          round(100.0::DOUBLE * count(s.record_id) / (SELECT count(*) FROM scored WHERE is_anomaly), 6) AS pct
        FROM codes c LEFT JOIN scored s ON s.fault_type = c.fault_type AND s.is_anomaly GROUP BY c.fault_type""",
    "fault_counts": f"{ON_SPECTRA} SELECT fault_label, count(*) AS n FROM alerts GROUP BY fault_label",
    "severity_counts": f"""{ON_SPECTRA} SELECT l.severity_level, CAST(l.sev_rank AS INTEGER) AS sev_rank, count(a.record_id) AS n
        FROM (VALUES ('HIGH', 0), ('MEDIUM', 1), ('LOW', 2)) l(severity_level, sev_rank)
        LEFT JOIN alerts a ON a.severity_level = l.severity_level GROUP BY ALL""",
    "fault_by_severity": f"""{ON_SPECTRA} SELECT fault_label, severity_level, count(*) AS n, {_short('fault_label')} AS fault_short,
          CAST({RANK} AS INTEGER) AS sev_rank FROM alerts GROUP BY fault_label, severity_level""",
    "device_fault_pivot": f"""{ON_SPECTRA} SELECT dev_eui, {', '.join(
        f'count(*) FILTER (fault_type = {c} AND event_id % 9 <> 0) AS "{short_text(label)}"' for c, label in FAULT_LABELS.items())},
        count(*) FILTER (event_id % 9 = 0) AS other FROM alerts GROUP BY dev_eui""",
    "box_stats": f"""{ON_FEATURES}, q AS (SELECT fault_label, quantile_cont(crest_factor, 0.25) AS q1,
          quantile_cont(crest_factor, 0.5) AS median, quantile_cont(crest_factor, 0.75) AS q3
          FROM scored WHERE is_anomaly GROUP BY fault_label),
        f AS (SELECT *, crest_factor BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM scored JOIN q USING (fault_label) WHERE is_anomaly)
        SELECT fault_label, count(*) AS n, round(min(crest_factor) FILTER (inside), 6) AS whisker_low,
          round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
          round(max(crest_factor) FILTER (inside), 6) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
        FROM f GROUP BY fault_label""",
    "box_outliers": f"""{ON_FEATURES}, q AS (SELECT fault_label, quantile_cont(rms, 0.25) AS q1, quantile_cont(rms, 0.75) AS q3
          FROM scored WHERE is_anomaly GROUP BY fault_label)
        SELECT record_id, fault_label FROM scored JOIN q USING (fault_label)
        WHERE is_anomaly AND NOT (rms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))""",
    "score_histogram": f"""{ON_EVENTS}, r AS (SELECT is_anomaly, min(anomaly_score) AS low,
          (max(anomaly_score) - min(anomaly_score)) / 30.0::DOUBLE AS width FROM scored GROUP BY is_anomaly)
        SELECT is_anomaly, CAST(least(floor((anomaly_score - low) / width), 29) AS INTEGER) AS bin, count(*) AS n
        FROM scored JOIN r USING (is_anomaly) GROUP BY ALL""",
    "score_threshold": f"""{ON_EVENTS} SELECT round((max(anomaly_score) FILTER (is_anomaly)
          + min(anomaly_score) FILTER (NOT is_anomaly)) / 2, 6) AS threshold FROM scored""",
    "mean_confidence": f"""{ON_EVENTS} SELECT round(avg(confidence), 6) AS mean_confidence FROM scored WHERE is_anomaly""",
    "latest_alerts": f"""{ON_SPECTRA} SELECT record_id, dev_eui, axis_label, ts_ms, fault_label, severity_level FROM alerts
        ORDER BY ts_ms DESC, record_id LIMIT 20""",
    "clearest_examples": f"""{ON_SPECTRA} SELECT record_id, CASE WHEN is_anomaly THEN 'Anomalia' ELSE 'Normal' END AS class,
          round(anomaly_score, 6) AS anomaly_score, CAST(len(vals) AS INTEGER) AS points FROM scored
        QUALIFY row_number() OVER (PARTITION BY is_anomaly
          ORDER BY CASE WHEN is_anomaly THEN anomaly_score ELSE -anomaly_score END, record_id) <= 2""",
    "sorted_labels": f"{ON_SPECTRA} SELECT DISTINCT fault_label FROM alerts",
    "contamination": """SELECT count(*) AS n, least(0.2::DOUBLE, greatest(0.1::DOUBLE, count(*) / 10000.0::DOUBLE))
          AS contamination FROM events""",
    "alerts_per_period": f"""{ON_SPECTRA} SELECT dev_eui, date_trunc('day', ts)::TIMESTAMP AS period_start, count(*) AS alerts
        FROM alerts GROUP BY ALL""",
    "indicator_evolution": f"""{ON_FEATURES} SELECT dev_eui,
          date_trunc('day', make_timestamp(CAST(ts_ms AS BIGINT) * 1000))::TIMESTAMP AS period_start, count(*) AS records,
          round(avg(rms), 6) AS mean_rms, round(avg(CAST(is_anomaly AS DOUBLE)), 6) AS anomaly_rate FROM scored GROUP BY ALL""",
    "fleet_comparison": f"""{ON_FEATURES}, named AS (SELECT dev_eui || '/' || CAST(mode AS INTEGER) || '/' || CAST(axis AS INTEGER) AS dev_eui, rms,
          date_trunc('day', make_timestamp(CAST(ts_ms AS BIGINT) * 1000))::TIMESTAMP AS period_start FROM scored),
        means AS (SELECT dev_eui, period_start, count(*) AS records, avg(rms) AS mean FROM named GROUP BY ALL),
        fleet AS (SELECT period_start, quantile_cont(mean, 0.25) AS low, quantile_cont(mean, 0.5) AS median, quantile_cont(mean, 0.75) AS high
          FROM means GROUP BY period_start),
        placed AS (SELECT dev_eui, period_start, records, mean, median, CASE WHEN high > low THEN (mean - median) / (high - low) END AS deviation
          FROM means JOIN fleet USING (period_start))
        SELECT dev_eui, period_start, records, round(mean, 6) AS mean, round(median, 6) AS fleet_median, round(deviation, 6) + 0.0::DOUBLE AS deviation,
          CASE WHEN abs(round(deviation, 6)) > 1.5 THEN 'far' ELSE 'near' END AS distance FROM placed""",
    "persistence_rows": f"{ON_SPECTRA} SELECT record_id, {PERSISTENT} AS persistent FROM scored",
    "persistence_range": f"""{ON_SPECTRA} SELECT record_id, is_anomaly AND sum(CAST(is_anomaly AS INTEGER)) OVER ({SERIES}
          ORDER BY ts_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW) >= 2 AS persistent FROM scored""",
    "extreme_scores": f"""{ON_SPECTRA}, q AS (SELECT dev_eui, mode, axis, quantile_cont(anomaly_score, 0.05) AS q
          FROM scored GROUP BY ALL)
        SELECT record_id, anomaly_score < q AS extreme FROM scored JOIN q USING (dev_eui, mode, axis)""",
    "confirmed_anomalies": f"""{ON_SPECTRA}, q AS (SELECT dev_eui, mode, axis, quantile_cont(anomaly_score, 0.05) AS q
          FROM scored GROUP BY ALL)
        SELECT record_id, {PERSISTENT} OR anomaly_score < q AS confirmed FROM scored JOIN q USING (dev_eui, mode, axis)""",
}

# --- Models ---

COUNTED = """counted AS (SELECT count(*) AS n, least(0.2::DOUBLE, greatest(0.1::DOUBLE, count(*) / 10000.0::DOUBLE)) AS c FROM events),
  flagged AS (SELECT n AS total, CAST(floor(c * (n - 1)) AS BIGINT) + 1 AS anomalies FROM counted)"""
LABELLED = f"""{SPECTRA}, labelled AS (SELECT record_id, true_label AS label,
  CAST(CASE WHEN event_id % 10 < 8 THEN true_label ELSE (true_label + 1) % 4 END AS INTEGER) AS prediction FROM spectra)"""
CLASS_SCORES = f"""{LABELLED}, classes AS (SELECT label AS class FROM labelled UNION SELECT prediction FROM labelled),
  sums AS (SELECT c.class, count(*) FILTER (l.label = c.class AND l.prediction = c.class) AS hits,
    count(*) FILTER (l.label = c.class) AS support, count(*) FILTER (l.prediction = c.class) AS predicted
    FROM classes c, labelled l GROUP BY c.class),
  rated AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS recall FROM sums),
  scores AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM rated)"""
MODEL_INPUTS_SQL = [*SPECTRAL_FEATURES, "mode", "axis"]
POINTS = """points AS (SELECT vec_id, CAST(vec_id AS VARCHAR) AS record_id, label,
  list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings)"""
DISTANCE = "sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


def _scale(columns: list[str], centre: str, scale: str) -> str:
    parts = []
    for c in columns:
        s = scale.format(c=c)
        parts.append(f"round(({c} - {centre.format(c=c)}) / CASE WHEN {s} = 0 THEN 1 ELSE {s} END, 6) + 0.0::DOUBLE AS {c}")
    return ", ".join(parts)


MOMENTS = f"""kept AS MATERIALIZED (SELECT * FROM features),
  m AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in MODEL_INPUTS_SQL)} FROM kept)"""
SCALED = f"""{MOMENTS}, scaled AS MATERIALIZED (SELECT record_id, [{', '.join(
    f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END" for c in MODEL_INPUTS_SQL)}] AS x FROM kept, m)"""


def _path(n: str) -> str:
    return (f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1) / {n}::DOUBLE "
            f"WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


def _forest(trees: int = 100, sub_sample: int = 256, seed: int = 42) -> str:
    """The forest level by level: sub-samples by digest, per node the ranges of the features, a cut by digest; then all
    records through all levels."""
    levels = (sub_sample - 1).bit_length()
    unit = lambda text: f"('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"
    features = range(1, len(MODEL_INPUTS_SQL) + 1)
    steps, walk = [], []
    for k in range(levels):
        steps.append(f"""n{k} AS MATERIALIZED (SELECT tree, node, count(*) AS n, [{', '.join(f'min(x[{f}])' for f in features)}] AS lo,
    [{', '.join(f'max(x[{f}])' for f in features)}] AS hi FROM s{k} GROUP BY tree, node),
  c{k} AS (SELECT *, list_filter(range(1, {len(features) + 1}), lambda f: hi[f] > lo[f]) AS open,
    md5('{seed}:' || tree || ':' || node) AS h FROM n{k} WHERE n > 1),
  f{k} AS (SELECT *, open[1 + ('0x' || substr(h, 14, 8))::BIGINT % len(open)] AS f,
    ('0x' || substr(h, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM c{k} WHERE len(open) > 0),
  p{k} AS MATERIALIZED (SELECT tree, node, f, lo[f] + u * (hi[f] - lo[f]) AS cut FROM f{k} WHERE lo[f] + u * (hi[f] - lo[f]) < hi[f]),
  s{k + 1} AS MATERIALIZED (SELECT s.tree, record_id, x, 2 * s.node + CASE WHEN x[f] <= cut THEN 0 ELSE 1 END AS node
    FROM s{k} s JOIN p{k} p ON s.tree = p.tree AND s.node = p.node)""")
        walk.append(f"""w{k + 1} AS (SELECT w.tree, record_id, x, CASE WHEN f IS NULL THEN w.node WHEN x[f] <= cut THEN 2 * w.node
    ELSE 2 * w.node + 1 END AS node FROM w{k} w LEFT JOIN p{k} p ON w.tree = p.tree AND w.node = p.node)""")
    sizes = " UNION ALL ".join(f"SELECT tree, node, n, {k} AS depth FROM n{k}" for k in range(levels + 1))
    return f"""{FEATURES}, {SCALED},
  s0 AS MATERIALIZED (SELECT tree, record_id, x, 1 AS node FROM scaled, range({trees}) r(tree)
    QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {unit(f"'{seed}:' || tree || ':' || record_id || ':1'")}, record_id) <= {sub_sample}),
  {', '.join(steps)}, n{levels} AS (SELECT tree, node, count(*) AS n FROM s{levels} GROUP BY tree, node),
  sizes AS MATERIALIZED ({sizes}),
  w0 AS (SELECT tree, record_id, x, 1 AS node FROM scaled, range({trees}) r(tree)), {', '.join(walk)},
  rated AS (SELECT record_id, -power(2.0::DOUBLE, -avg(depth + {_path('n')}) / ({_path(str(sub_sample))})) AS anomaly_score
    FROM w{levels} w JOIN sizes z ON w.tree = z.tree AND w.node = z.node GROUP BY record_id)"""


def _flagged() -> str:
    """The scores and their quantile at the contamination, below which records are anomalies."""
    return f"""{_forest().replace('WITH ', f'WITH {COUNTED}, ', 1)},
  ordered AS (SELECT anomaly_score AS s, row_number() OVER (ORDER BY anomaly_score) - 1 AS r, c * (n - 1) AS place FROM rated, counted),
  cut AS MATERIALIZED (SELECT min(s) FILTER (r = floor(place)) + (min(s) FILTER (r = ceil(place)) - min(s) FILTER (r = floor(place)))
    * (max(place) - floor(max(place))) AS q FROM ordered)"""


def _clusters(k: int = 4, starts: int = 10, seed: int = 42) -> str:
    """K-means of the forest's anomalies: first centres by waiting times, then all starts until they rest."""
    width = len(MODEL_INPUTS_SQL)
    far = "list_sum(list_transform(list_zip(p.x, t.c), lambda q: (q[1] - q[2]) * (q[1] - q[2])))"
    wait = lambda step: (f"-ln(1 - ('0x' || substr(md5('{seed}:' || start || ':{step}:' || record_id), 1, 13))::BIGINT"  # noqa: E731
                         f" / 4503599627370496.0::DOUBLE)")
    first = [f"""i0 AS MATERIALIZED (SELECT start, 0 AS k, x AS c FROM points, range({starts}) r(start)
    QUALIFY row_number() OVER (PARTITION BY start ORDER BY {wait(0)}, record_id) = 1)"""]
    for step in range(1, k):
        first.append(f"""d{step} AS (SELECT t.start, p.record_id, any_value(p.x) AS x, min({far}) AS d FROM points p, i{step - 1} t GROUP BY t.start, p.record_id),
  i{step} AS MATERIALIZED (SELECT * FROM i{step - 1} UNION ALL (SELECT start, {step} AS k, x AS c FROM d{step}
    QUALIFY row_number() OVER (PARTITION BY start ORDER BY CASE WHEN d > 0 THEN {wait(step)} / d ELSE 'inf'::DOUBLE END, record_id) = 1))""")
    return f"""{_flagged().replace('WITH ', 'WITH RECURSIVE ', 1)},
  points AS MATERIALIZED (SELECT record_id, x FROM scaled JOIN rated USING (record_id), cut WHERE anomaly_score < q),
  spread AS (SELECT 1e-4::DOUBLE * ({' + '.join(f'var_pop(x[{f}])' for f in range(1, width + 1))}) / {width} AS most FROM points),
  {', '.join(first)},
  it AS (SELECT start, k, c, 0 AS i, false AS rests FROM i{k - 1}
    UNION ALL
    SELECT start, k, c, i + 1, sum(moved) OVER (PARTITION BY start) <= (SELECT most FROM spread) FROM (
      SELECT o.start, o.k, o.i, coalesce(n.c, o.c) AS c, list_sum(list_transform(list_zip(o.c, coalesce(n.c, o.c)),
        lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS moved
      FROM it o LEFT JOIN (SELECT start, k, [{', '.join(f'avg(x[{f}])' for f in range(1, width + 1))}] AS c FROM (
        SELECT p.x, t.start, t.k, row_number() OVER (PARTITION BY t.start, p.record_id ORDER BY {far}, t.k) AS near FROM points p, it t
        WHERE NOT t.rests) WHERE near = 1 GROUP BY start, k) n ON n.start = o.start AND n.k = o.k
      WHERE NOT o.rests AND o.i < 300)),
  final AS MATERIALIZED (SELECT start, k, c FROM it QUALIFY i = max(i) OVER (PARTITION BY start)),
  placed AS MATERIALIZED (SELECT t.start, p.record_id, min({far}) AS d, arg_min(t.k, {far}) AS k FROM points p, final t GROUP BY t.start, p.record_id),
  best AS (SELECT start FROM placed GROUP BY start ORDER BY printf('%.8e', sum(d)::DOUBLE)::DOUBLE, start LIMIT 1)"""


ORACLE.update({
    "kmeans_best_of_10": f"""{_clusters()}
        SELECT record_id, CAST(k AS INTEGER) AS label FROM placed JOIN best USING (start)""",
    "standard_scale": f"""{FEATURES}, {MOMENTS}
        SELECT record_id, {_scale(MODEL_INPUTS_SQL, 'm_{c}', 's_{c}')} FROM kept, m""",
    "iforest_scores": f"""{_forest()}
        SELECT record_id, round(anomaly_score, 6) + 0.0::DOUBLE AS anomaly_score FROM rated""",
    "robust_scale": f"""{FEATURES}, m AS (SELECT {', '.join(
        f'quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}' for c in SPECTRAL_FEATURES)}
          FROM features)
        SELECT record_id, {_scale(SPECTRAL_FEATURES, 'm_{c}', 's_{c}')} FROM features, m""",
    "iforest_predict": f"""WITH {COUNTED} SELECT total, anomalies, total - anomalies AS normals,
          round(100.0::DOUBLE * anomalies / total, 6) AS pct_anomalies FROM flagged""",
    "prediction_checks": f"""WITH {COUNTED} SELECT total, anomalies, total - anomalies AS clean_normals,
          anomalies AS sound_anomalies FROM flagged""",
    "model_roundtrip": f"""{_flagged()} SELECT record_id, round(anomaly_score, 6) + 0.0::DOUBLE AS anomaly_score,
          anomaly_score < q AS is_anomaly FROM rated, cut""",
    "stream_predictions": f"{_flagged()} SELECT record_id, anomaly_score < q AS is_anomaly, true AS sound FROM rated, cut",
    "train": f"""{_clusters()}, sized AS (SELECT CAST(k AS INTEGER) AS label, count(*) AS n FROM placed JOIN best USING (start) GROUP BY k)
        SELECT label, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM sized), 6) AS pct FROM sized""",
    "nearest_centre": f"""WITH {POINTS} SELECT a.vec_id, CAST(arg_min(b.vec_id, {DISTANCE}) AS INTEGER) AS cluster
        FROM points a, points b WHERE b.vec_id < 4 GROUP BY a.vec_id""",
    "cluster_distribution": f"""WITH {LABELLED} SELECT label, count(*) AS n,
          round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM labelled), 6) AS pct FROM labelled GROUP BY label""",
    "silhouette_euclid": f"""WITH {POINTS}, sample AS (SELECT * FROM points ORDER BY {TIE}, record_id LIMIT 5000),
        sizes AS (SELECT label, count(*) AS n FROM sample GROUP BY label),
        sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({DISTANCE}) AS s FROM sample a, sample b GROUP BY ALL),
        means AS (SELECT vec_id, own, max(s / greatest(n - 1, 1)) FILTER (own = other) AS inner_mean,
          min(s / n) FILTER (own <> other) AS outer_mean, max(n) FILTER (own = other) AS own_size
          FROM sums JOIN sizes ON sizes.label = sums.other GROUP BY vec_id, own),
        total AS (SELECT avg(CASE WHEN own_size = 1 THEN 0 ELSE (outer_mean - inner_mean) / greatest(inner_mean, outer_mean) END) AS s,
          count(*) AS n FROM means)
        SELECT round(s, 6) AS silhouette, n AS rows,
          CASE WHEN s >= 0.5 THEN 'good' WHEN s >= 0.3 THEN 'moderate' ELSE 'low' END AS verdict FROM total""",
    "silhouette_all": f"""WITH {POINTS},
        sizes AS (SELECT label, count(*) AS n FROM points GROUP BY label),
        sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(power({DISTANCE}, 2)) AS s FROM points a, points b GROUP BY ALL),
        means AS (SELECT vec_id, max(s / greatest(n - 1, 1)) FILTER (own = other) AS inner_mean,
          min(s / n) FILTER (own <> other) AS outer_mean FROM sums JOIN sizes ON sizes.label = sums.other GROUP BY vec_id)
        SELECT round(avg((outer_mean - inner_mean) / greatest(inner_mean, outer_mean)), 6) AS silhouette FROM means""",
    "lof_scores": f"""WITH {POINTS}, pairs AS (SELECT a.record_id, b.record_id AS other, {DISTANCE} AS d
          FROM points a, points b WHERE a.record_id <> b.record_id),
        near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY d, other) <= 20),
        k AS (SELECT record_id, max(d) AS kd FROM near GROUP BY record_id),
        lrd AS (SELECT n.record_id, 1 / (avg(greatest(k.kd, n.d)) + 1e-10::DOUBLE) AS lrd
          FROM near n JOIN k ON k.record_id = n.other GROUP BY n.record_id)
        SELECT n.record_id, round(avg(o.lrd) / max(own.lrd), 6) AS lof FROM near n JOIN lrd o ON o.record_id = n.other
          JOIN lrd own ON own.record_id = n.record_id GROUP BY n.record_id""",
    "stratified_folds": f"""WITH {LABELLED} SELECT record_id, label, CAST((row_number() OVER (PARTITION BY label
          ORDER BY {TIE}, record_id) - 1) % 5 AS INTEGER) AS fold FROM labelled""",
    "confusion_matrix": f"""WITH {LABELLED} SELECT label, {', '.join(
        f'count(*) FILTER (prediction = {c}) AS pred_{c}' for c in range(4))} FROM labelled GROUP BY label""",
    "accuracy_f1_macro": f"""WITH {CLASS_SCORES} SELECT round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy,
          round(avg(f1), 6) AS f1_macro FROM scores""",
    "classification_report": f"""WITH {CLASS_SCORES},
        report AS (SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM scores
          UNION ALL SELECT 'accuracy', NULL, NULL, sum(hits) / sum(support)::DOUBLE, sum(support) FROM scores
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM scores)
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
          CAST(support AS BIGINT) AS support FROM report""",
    # The parsed lines of the batch query, without the id.
    "stream_features": f"""WITH {SPECTRA}, {PARSED}, {_features(source='parsed')}
        SELECT dev_eui, mode, axis, ts_ms, {_round(*SPECTRAL_FEATURES)} FROM features""",
    # Windows are emitted once the watermark (newest record minus one hour) has reached their end.
    "stream_persistence": f"""{ON_SPECTRA}, timed AS (SELECT *, CAST(ts_ms AS BIGINT) AS ms FROM scored),
        windows AS (SELECT dev_eui, mode, axis, is_anomaly, (ms // 10800000 - k) * 10800000 AS start_ms
          FROM timed, (VALUES (0), (1)) o(k)),
        counted AS (SELECT dev_eui, mode, axis, start_ms, sum(CAST(is_anomaly AS INTEGER)) AS anomalies FROM windows GROUP BY ALL)
        SELECT dev_eui, mode, axis, make_timestamp(start_ms * 1000) AS window_start,
          make_timestamp((start_ms + 21600000) * 1000) AS window_end, CAST(anomalies AS BIGINT) AS anomalies
        FROM counted WHERE anomalies >= 2""",
    "stream_alerts": f"""{ON_SPECTRA}, timed AS (SELECT *, CAST(ts_ms AS BIGINT) AS ms FROM scored),
        counted AS (SELECT dev_eui, ms // 86400000 * 86400000 AS start_ms, count(*) AS alerts FROM timed
          WHERE is_anomaly GROUP BY ALL)
        SELECT dev_eui, make_timestamp(start_ms * 1000) AS period_start, alerts FROM counted""",
})

ORACLE |= {
    "feature_files": f"""{FEATURES} SELECT fmt, record_id, dev_eui, {_round('axis', 'rms', 'crest_factor')}
        FROM features, (VALUES ('parquet'), ('csv')) AS f(fmt)""",
    "feature_metadata": f"{FEATURES} SELECT record_id, dev_eui, mode, axis, ts_ms FROM features",
    "model_inputs": f"""WITH {SPECTRA}, {_features()} SELECT record_id, {", ".join(
        f"round(CASE WHEN event_id % 7 = 0 THEN 0 ELSE temp END, 6) AS temp" if c == "temp" else f"round({c}, 6) + 0.0::DOUBLE AS {c}"
        for c in MODEL_INPUTS)} FROM features""",
    "prediction_files": f"{ON_EVENTS} SELECT record_id, is_anomaly, fault_type, confidence FROM scored",
    "prediction_arrays": f"{ON_EVENTS} SELECT record_id, is_anomaly, fault_type FROM scored",
    "alert_files": f"""{ON_SPECTRA} SELECT record_id, dev_eui, fault_type, {DESCRIBED} AS fault_label, severity_level
        FROM scored WHERE is_anomaly""",
    "report_frame_files": f"""{ON_FEATURES} SELECT record_id, dev_eui, round(rms, 6) AS rms,
        CASE WHEN event_id % 11 <> 0 THEN is_anomaly END AS is_anomaly,
        CASE WHEN event_id % 11 <> 0 THEN fault_type END AS fault_type,
        CASE WHEN event_id % 11 <> 0 THEN confidence END AS confidence FROM scored""",
    "chronological_order": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS inversions FROM events",
    "text_stream": f"""WITH {SPECTRA}, {PARSED} SELECT dev_eui, ts_ms, CAST(len(vals) AS INTEGER) AS points FROM parsed""",
}
