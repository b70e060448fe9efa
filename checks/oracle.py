"""The expected result of each query, as SQL that DuckDB runs on the same tables."""

from __future__ import annotations


from cardwarden.schemas import (
    FEATURE_TABLE_COLUMNS,

    LOGISTIC_FEATURES,
    TEXT_FEATURES,
    VIEW_IDENTITY_COLUMNS,
    VIEW_TRANSACTION_COLUMNS,
)
from checks import bind


PASSED = [
    "TransactionAmt", "card1", "card4", "card6", "addr1", "P_emaildomain", "DeviceType",
    "C1", "C2", "C5", "C6", "C13", "C14", "D1", "D4", "D10", "D15", "M4", "M5", "M6",
]
ROUNDED = [
    "card1_avg_amt", "card1_std_amt", "card1_historical_fraud_rate", "email_domain_fraud_rate",
]


def _flag(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT)"


def _hour(ts: str) -> str:
    return f"CAST(extract(hour FROM {ts}) AS BIGINT)"


def _weekday(ts: str) -> str:
    return f"CAST(extract(isodow FROM {ts}) - 1 AS BIGINT)"


def _bucket(amount: str) -> str:
    return (
        f"CASE WHEN {amount} < 50 THEN 'low' WHEN {amount} < 200 THEN 'medium' "
        f"WHEN {amount} < 1000 THEN 'high' ELSE 'very_high' END"
    )


def _risk(p: str) -> str:
    return (
        f"CASE WHEN {p} >= 0.8 THEN 'HIGH' WHEN {p} >= 0.5 THEN 'MEDIUM' "
        f"WHEN {p} >= 0.3 THEN 'LOW' ELSE 'SAFE' END"
    )


def _fixed_score(name: str) -> str:
    intercept, weights = bind.FIXED_SCORES[name]
    logit = f"CAST({intercept} AS DOUBLE)"
    for column, weight in weights.items():
        logit = f"({logit} + CAST({weight} AS DOUBLE) * {column})"
    return f"1 / (1 + exp(-{logit}))"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _one_feature(p: str) -> str:
    """Scores of a model of one 0/1 feature, whose probability has a closed form."""
    return (
        "SELECT *, CAST(p > 0.5 AS BIGINT) AS predicted FROM ("
        f"SELECT f.*, {p} AS p FROM feat f JOIN weighted ON is_late_night = v WHERE isFraud IS NOT NULL)"
    )


def _test_scores(rows: str, digits: int) -> str:
    return _with(
        rows,
        f"""SELECT TransactionID, isFraud, predicted AS predicted_isFraud,
            round(p, {digits}) AS fraud_probability FROM {rows} WHERE TransactionID % 10 >= 8""",
    )


CTES = {
    "ev": bind.EVENTS_DUCKDB,
    "tx": f"SELECT *, TIMESTAMP '2017-11-30 00:00:00' + to_seconds(TransactionDT) "
    f"AS transaction_timestamp FROM (SELECT {_select(bind.EVENT_COLUMNS)} FROM ev)",
    "idn": f"SELECT {_select(bind.IDENTITY_COLUMNS)} FROM ({bind.ORDERS_DUCKDB})",
    "cards": "SELECT card1, count(*) AS card1_tx_count, avg(TransactionAmt) AS card1_avg_amt, "
    "stddev_samp(TransactionAmt) AS card1_std_amt, avg(isFraud) AS card1_historical_fraud_rate "
    "FROM tx WHERE card1 IS NOT NULL GROUP BY card1",
    "domains": "SELECT P_emaildomain, count(*) AS email_tx_count, "
    "avg(isFraud) AS email_domain_fraud_rate FROM tx "
    "WHERE P_emaildomain <> '' GROUP BY P_emaildomain",
    "feat": f"""
        SELECT t.TransactionID, t.isFraud, t.ProductCD,
            {", ".join(("i." if c == "DeviceType" else "t.") + c for c in PASSED)},
            round_even(ln(t.TransactionAmt + 1), 4) AS log_tx_amt,
            round_even(t.TransactionAmt - round_even(t.TransactionAmt, 0), 4) AS amt_decimal_part,
            {_bucket("t.TransactionAmt")} AS amt_bucket,
            {_hour("transaction_timestamp")} AS tx_hour,
            {_weekday("transaction_timestamp")} AS tx_day_of_week,
            {_flag("extract(hour FROM transaction_timestamp) < 6")} AS is_late_night,
            {_flag("t.dist1 IS NULL")} AS dist1_is_null,
            {_flag("t.dist2 IS NULL")} AS dist2_is_null,
            {_flag("coalesce(t.P_emaildomain, '') = ''")} AS email_is_null,
            {_flag("coalesce(i.DeviceType, '') = ''")} AS device_is_null,
            {_flag("i.DeviceType = 'mobile'")} AS is_mobile,
            coalesce(d.email_domain_fraud_rate, 0.035) AS email_domain_fraud_rate,
            c.card1_tx_count, c.card1_avg_amt, c.card1_std_amt,
            coalesce(c.card1_historical_fraud_rate, 0.035) AS card1_historical_fraud_rate,
            round_even((t.TransactionAmt - coalesce(nullif(c.card1_avg_amt, 0), t.TransactionAmt))
                / coalesce(nullif(c.card1_std_amt, 0), 1), 4) AS amt_zscore_vs_card
        FROM tx t LEFT JOIN idn i USING (TransactionID)
        LEFT JOIN cards c ON t.card1 = c.card1
        LEFT JOIN domains d ON t.P_emaildomain = d.P_emaildomain""",
    "scored": f"SELECT *, p, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS predicted "
    f"FROM (SELECT *, {_fixed_score('XGBoost')} AS p FROM feat WHERE isFraud IS NOT NULL)",
    "msg": f"""
        SELECT *, event_id % {bind.MESSAGE_SHAPES} AS shape,
            event_id % {bind.MESSAGE_SHAPES} IN {bind.MALFORMED_SHAPES} AS malformed,
            {bind._DEVICE} AS DeviceType, make_timestamp(secs * 1000000) AS ts
        FROM (SELECT event_id, secs, user_id, k, {_select(bind.EVENT_COLUMNS)} FROM ev)""",
    "checked": f"""
        SELECT *, concat_ws(',',
            CASE WHEN event_id = 0 AND shape NOT IN (4, 5) THEN 'TransactionID' END,
            CASE WHEN shape IN (3, 9) OR (TransactionAmt = 0 AND shape <> 8)
                THEN 'TransactionAmt' END,
            CASE WHEN shape IN (2, 9) THEN 'ProductCD' END) AS missing,
            CASE shape WHEN 5 THEN 'TransactionID' WHEN 10 THEN 'addr1' WHEN 13 THEN 'isFraud'
                WHEN 14 THEN 'tx_hour' ELSE '' END AS bad_fields
        FROM msg""",
    "routed": """
        SELECT *, CASE WHEN malformed THEN 'malformed' WHEN missing <> '' THEN 'invalid'
            WHEN bad_fields <> '' THEN 'cast_error' ELSE 'valid' END AS route
        FROM checked""",
    "req": f"""
        SELECT event_id, event_id % {bind.REQUEST_SHAPES} AS shape,
            event_id % {bind.REQUEST_SHAPES} IN (0, 3, 5) AS known,
            make_timestamp(secs * 1000000) AS clock, user_id, k,
            CASE event_id % {bind.REQUEST_SHAPES} WHEN 5 THEN -5.5 ELSE value END AS TransactionAmt
        FROM ev""",
    "answered": f"""
        SELECT event_id, clock, TransactionAmt, 'W' AS ProductCD,
            CASE WHEN shape IN (4, 8) THEN 'invalid_request'
                WHEN shape IN (3, 5) THEN 'scoring_failed' END AS error,
            CASE WHEN TransactionAmt > -1 THEN round_even(ln(TransactionAmt + 1), 4) END AS log_tx_amt,
            {_bucket("TransactionAmt")} AS amt_bucket,
            round_even(TransactionAmt - round_even(TransactionAmt, 0), 4) AS amt_decimal_part,
            {_hour("clock")} AS tx_hour, {_weekday("clock")} AS tx_day_of_week,
            {_flag("extract(hour FROM clock) < 6")} AS is_late_night,
            CAST(CASE WHEN shape = 0 AND user_id <> 0 THEN user_id ELSE 1000 END AS BIGINT) AS card1,
            CAST(NULL AS VARCHAR) AS card4, CAST(NULL AS VARCHAR) AS card6,
            CAST(0 AS DOUBLE) AS addr1,
            CAST(1 AS BIGINT) AS dist1_is_null, CAST(1 AS BIGINT) AS dist2_is_null,
            CASE WHEN known THEN 'gmail.com' WHEN shape = 6 THEN '' END AS P_emaildomain,
            {_flag("NOT known")} AS email_is_null,
            CASE WHEN shape = 7 THEN 0.25 ELSE 0.035 END::DOUBLE AS email_domain_fraud_rate,
            CASE WHEN known THEN 'desktop' WHEN shape = 6 THEN 'mobile' END AS DeviceType,
            {_flag("NOT known AND shape <> 6")} AS device_is_null,
            {_flag("shape = 6")} AS is_mobile,
            CAST(CASE WHEN known THEN 7 ELSE 1 END AS BIGINT) AS card1_tx_count,
            CASE WHEN known THEN 40.5::DOUBLE ELSE TransactionAmt END AS card1_avg_amt,
            CASE WHEN known THEN 12.5 ELSE 1 END::DOUBLE AS card1_std_amt,
            CASE WHEN known THEN k::DOUBLE / 100 ELSE 0.035::DOUBLE END AS card1_historical_fraud_rate,
            CASE WHEN known THEN round_even((TransactionAmt - 40.5) / 12.5::DOUBLE, 4)
                ELSE 0 END::DOUBLE AS amt_zscore_vs_card,
            1.0::DOUBLE AS C1, CASE WHEN known THEN 3 ELSE 1 END::DOUBLE AS C2,
            0.0::DOUBLE AS C5, 1.0::DOUBLE AS C6, 1.0::DOUBLE AS C13, 1.0::DOUBLE AS C14,
            0.0::DOUBLE AS D1, 0.0::DOUBLE AS D4, 0.0::DOUBLE AS D10, 0.0::DOUBLE AS D15,
            CAST(NULL AS VARCHAR) AS M4, CAST(NULL AS VARCHAR) AS M5, CAST(NULL AS VARCHAR) AS M6
        FROM req""",
    # Weighted fraud and other rows of each value of one feature, each class with the same total.
    "weighted": """
        SELECT v, sum(w) FILTER (y = 1) AS pos, sum(w) FILTER (y = 0) AS neg FROM (
            SELECT is_late_night AS v, isFraud AS y,
                count(*) OVER () / (2 * count(*) OVER (PARTITION BY isFraud))::DOUBLE AS w
            FROM feat WHERE isFraud IS NOT NULL AND TransactionID % 10 < 8) GROUP BY v""",
    "logistic1": _one_feature("pos / (pos + neg)"),
    "boosted1": _one_feature("1 / (1 + exp(-2 * (pos - neg) / (pos + neg)))"),
}
NEEDS = {
    "ev": [],
    "tx": ["ev"],
    "idn": [],
    "cards": ["tx"],
    "domains": ["tx"],
    "feat": ["tx", "idn", "cards", "domains"],
    "scored": ["feat"],
    "msg": ["ev"],
    "checked": ["msg"],
    "routed": ["checked"],
    "req": ["ev"],
    "answered": ["req"],
    "weighted": ["feat"],
    "logistic1": ["weighted"],
    "boosted1": ["weighted"],
}


def _with(last: str, select: str) -> str:
    """The select with the named subquery and all that it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS[name]:
            visit(needed)
        if name not in order:
            order.append(name)

    visit(last)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order) + " " + select


def _features(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" if c in ROUNDED else c for c in columns)


SCORE_COLUMNS = f"""
    TransactionID, isFraud AS actual_fraud, predicted AS predicted_fraud,
    round(p, 6) AS fraud_probability, TransactionAmt, ProductCD, card4, card6, P_emaildomain,
    DeviceType, tx_hour, is_late_night, amt_bucket,
    {_features(["card1_historical_fraud_rate", "email_domain_fraud_rate"])},
    amt_zscore_vs_card, {_risk("p")} AS risk_level"""

CELLS = """
    CAST(count(*) FILTER (isFraud = 1 AND predicted = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (isFraud = 0 AND predicted = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (isFraud = 1 AND predicted = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (isFraud = 0 AND predicted = 0) AS DOUBLE) AS tn"""
MEASURES = """
    round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall,
    round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1_score"""


def _auc(rows: str) -> str:
    """Mean rank of the positives, with average ranks for ties."""
    return f"""(
        SELECT round((sum(r) FILTER (y = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 9) FROM (
            SELECT y, rank() OVER (ORDER BY s)
                + (count(*) OVER (PARTITION BY s) - 1) / 2::DOUBLE AS r,
                CAST(sum(y) OVER () AS DOUBLE) AS n1, CAST(sum(1 - y) OVER () AS DOUBLE) AS n0
            FROM (SELECT isFraud AS y, p AS s FROM {rows})) GROUP BY n1, n0)"""


def _comparison() -> str:
    parts = []
    for name in ("Logistic Regression", "XGBoost"):
        rows = (
            f"(SELECT *, CAST(p > 0.5 AS INT) AS predicted FROM (SELECT *, {_fixed_score(name)} AS p "
            "FROM feat WHERE isFraud IS NOT NULL AND TransactionID % 10 >= 8))"
        )
        parts.append(
            f"SELECT '{name}' AS model, {_auc(rows)} AS roc_auc, {MEASURES} "
            f"FROM (SELECT {CELLS} FROM {rows})"
        )
    return " UNION ALL ".join(parts)


def _rate(key: str, rows: str, label: str = "isFraud") -> str:
    return (
        f"SELECT {key}, count(*) AS transactions, count(*) FILTER ({label} = 1) AS fraud, "
        f"round(avg({label}), 6) AS fraud_rate FROM {rows} GROUP BY {key}"
    )


RECORD = {
    "TransactionID": "CASE WHEN shape <> 5 THEN TransactionID END",
    "TransactionAmt": "CASE shape WHEN 3 THEN 0 WHEN 9 THEN NULL ELSE TransactionAmt END",
    "card1": "card1",
    "addr1": "CASE WHEN shape <> 10 THEN addr1 END",
    "addr2": "addr2",
    "dist1": "dist1",
    "isFraud": "CASE WHEN shape <> 13 THEN isFraud END",
    "tx_hour": f"CASE WHEN shape <> 14 THEN {_hour('ts')} END",
}

ORACLE: dict[str, str] = {
    "base_view": f"""
        WITH ev AS ({CTES["ev"]}), tx AS ({CTES["tx"]}), idn AS ({CTES["idn"]})
        SELECT {", ".join("t." + c for c in VIEW_TRANSACTION_COLUMNS)},
            {", ".join("i." + c for c in VIEW_IDENTITY_COLUMNS)}
        FROM tx t LEFT JOIN idn i ON t.TransactionID = i.TransactionID""",
    "time_features": _with(
        "tx",
        f"""SELECT TransactionID, transaction_timestamp, {_hour("transaction_timestamp")} AS tx_hour,
            {_weekday("transaction_timestamp")} AS tx_day_of_week,
            {_flag("extract(hour FROM transaction_timestamp) < 6")} AS is_late_night FROM tx""",
    ),
    "amt_features": _with(
        "feat",
        "SELECT TransactionID, TransactionAmt, log_tx_amt, amt_decimal_part, amt_bucket FROM feat",
    ),
    "null_flags": _with(
        "feat",
        """SELECT TransactionID, email_is_null, device_is_null, is_mobile, dist1_is_null,
            dist2_is_null FROM feat""",
    ),
    "card_aggregates": _with(
        "cards",
        f"""SELECT card1, card1_tx_count,
            {_features(["card1_avg_amt", "card1_std_amt", "card1_historical_fraud_rate"])}
            FROM cards""",
    ),
    "email_domain_risk": _with(
        "domains",
        f"SELECT P_emaildomain, email_tx_count, {_features(['email_domain_fraud_rate'])} FROM domains",
    ),
    "ml_features": _with("feat", f"SELECT {_features(FEATURE_TABLE_COLUMNS)} FROM feat"),
    "train_split": _with(
        "feat", f"SELECT {_features(FEATURE_TABLE_COLUMNS)} FROM feat WHERE TransactionID % 10 < 8"
    ),
    "test_split": _with(
        "feat", f"SELECT {_features(FEATURE_TABLE_COLUMNS)} FROM feat WHERE TransactionID % 10 >= 8"
    ),
    "labelled_rows": _with(
        "tx",
        """SELECT TransactionID, isFraud, TransactionAmt, ProductCD FROM tx
            WHERE isFraud IS NOT NULL""",
    ),
    "class_weights": _with(
        "tx",
        """SELECT isFraud, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS class_weight
            FROM (SELECT isFraud, count(*) AS n FROM tx WHERE isFraud IS NOT NULL GROUP BY 1)""",
    ),
    "rate_by_product": _with("tx", _rate("ProductCD", "tx")),
    "late_night_lift": _with(
        "tx",
        """SELECT round(night, 6) AS night_rate, round(day, 6) AS day_rate,
            round(night / nullif(day, 0) - 1, 6) AS lift
            FROM (SELECT avg(isFraud) FILTER (extract(hour FROM transaction_timestamp) < 6) AS night,
                avg(isFraud) FILTER (extract(hour FROM transaction_timestamp) >= 6) AS day FROM tx)""",
    ),
    "overall_rate": _with(
        "tx",
        """SELECT count(*) AS transactions, count(*) FILTER (isFraud = 1) AS fraud,
            round(avg(isFraud), 6) AS fraud_rate FROM tx""",
    ),
    "risk_level": _with(
        "scored",
        f"""SELECT TransactionID, {_risk("p")} AS batch_level,
            {_risk("round_even(p, 6)")} AS service_level FROM scored""",
    ),
    "prob_by_label": _with(
        "scored",
        """SELECT TransactionID, round(p, 6) AS fraud_prob, round(1 - p, 6) AS legit_prob,
            round(p, 6) AS first_prob, CAST(NULL AS DOUBLE) AS absent_prob FROM scored""",
    ),
    "fraud_scores": _with("scored", f"SELECT {SCORE_COLUMNS} FROM scored"),
    "score_join": _with(
        "scored",
        f"""SELECT {SCORE_COLUMNS} FROM (
            SELECT f.*, s.p, s.predicted FROM scored s JOIN feat f
            ON s.TransactionID = f.TransactionID)""",
    ),
    "rate_by_risk": _with("scored", _rate("risk_level", f"(SELECT *, {_risk('p')} AS risk_level FROM scored)")),
    "confusion_metrics": _with(
        "scored",
        f"""SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
            CAST(tn AS BIGINT) AS tn, {MEASURES},
            round((tp + tn) / nullif(tp + fp + fn + tn, 0), 9) AS accuracy
            FROM (SELECT {CELLS} FROM scored)""",
    ),
    "roc_auc": _with("scored", f"SELECT {_auc('scored')} AS roc_auc"),
    "model_comparison": _with("feat", _comparison()),
    "top_k": _with(
        "cards",
        """SELECT card1, round(card1_historical_fraud_rate, 9) AS fraud_rate FROM cards
            ORDER BY fraud_rate DESC NULLS LAST, card1 LIMIT 15""",
    ),
    "bounded_read": "SELECT event_id FROM events ORDER BY event_id LIMIT 100",
    "encode_messages": _with(
        "msg",
        """SELECT TransactionID, TransactionAmt, card1, CAST(isFraud AS VARCHAR) AS is_fraud,
            ProductCD AS product_cd FROM msg""",
    ),
    "filter_attr": _with("msg", "SELECT TransactionID FROM msg WHERE ProductCD = 'C'"),
    "preview": _with(
        "msg",
        f"""SELECT TransactionID, CASE WHEN isFraud = 1 THEN 'FRAUD' ELSE 'Legit' END AS label,
            '$' || CAST(TransactionAmt AS VARCHAR) AS amount, ProductCD, card4, P_emaildomain,
            DeviceType, {_hour("ts")} AS tx_hour,
            CASE WHEN extract(hour FROM ts) < 6 THEN 'Late night' ELSE 'Daytime' END AS time_of_day,
            strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at
            FROM msg ORDER BY TransactionID LIMIT 10""",
    ),
    "parse_json": _with("msg", f"SELECT event_id, {_flag('NOT malformed')} AS parsed FROM msg"),
    "validate_required": _with(
        "checked", "SELECT event_id, missing FROM checked WHERE NOT malformed"
    ),
    "cast_fields": _with(
        "checked",
        f"SELECT event_id, {_select(RECORD)}, bad_fields FROM checked WHERE NOT malformed",
    ),
    "conform_schema": _with(
        "routed",
        f"""SELECT TransactionID, isFraud, TransactionDT, TransactionAmt, ProductCD, card1, card4,
            card6, addr1, addr2, dist1, P_emaildomain, R_emaildomain, DeviceType,
            'Windows' AS DeviceInfo, {_hour("ts")} AS tx_hour, {_weekday("ts")} AS tx_day_of_week,
            {_flag("extract(hour FROM ts) < 6")} AS is_late_night,
            round_even(ln(TransactionAmt + 1), 4) AS log_tx_amt,
            {_flag("coalesce(P_emaildomain, '') = ''")} AS email_is_null,
            {_flag("coalesce(DeviceType, '') = ''")} AS device_is_null,
            CAST(1 AS BIGINT) AS is_stamped FROM routed WHERE route = 'valid'""",
    ),
    "dead_letters": _with(
        "routed",
        """SELECT route AS reason,
            CASE WHEN malformed THEN NULL WHEN shape = 5 THEN 'tx' || TransactionID
                ELSE CAST(TransactionID AS VARCHAR) END AS TransactionID,
            CASE WHEN NOT malformed THEN missing END AS missing,
            CASE WHEN NOT malformed THEN bad_fields END AS bad_fields
            FROM routed WHERE route <> 'valid'""",
    ),
    "route_totals": _with(
        "routed",
        """SELECT route, count(*) AS messages, fraud, count(*) - fraud AS legit,
            round(fraud / count(*), 6) AS fraud_share
            FROM (SELECT route, count(*) FILTER (isFraud = 1 AND NOT malformed AND shape <> 13)
                OVER (PARTITION BY route) AS fraud FROM routed) GROUP BY route, fraud""",
    ),
    "request_features": _with(
        "answered",
        f"""SELECT event_id, ProductCD, {", ".join(LOGISTIC_FEATURES)}
            FROM answered WHERE error IS NULL""",
    ),
    "score_requests": _with(
        "answered",
        f"""SELECT event_id, error, round_even(p, 6) AS fraud_probability,
            CASE WHEN error IS NULL THEN CAST(p > 0.5 AS BIGINT) END AS predicted_fraud,
            CASE WHEN error IS NULL THEN {_risk("round_even(p, 6)")} END AS risk_level,
            CASE WHEN error IS NULL THEN TransactionAmt END AS transaction_amount,
            CASE WHEN error IS NULL THEN 'xgboost' END AS model,
            CASE WHEN error IS NULL THEN clock END AS scored_at
            FROM (SELECT event_id, clock, error, TransactionAmt, CASE WHEN error IS NULL THEN {_fixed_score("XGBoost")} END AS p
                FROM answered)""",
    ),
}

_BEFORE = """WINDOW h AS (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_OTHERS = (
    "(sum(isFraud) OVER (PARTITION BY {0}) - coalesce(sum(isFraud) OVER (PARTITION BY {0}, TransactionID % 5), 0))"
    " / nullif(count(isFraud) OVER (PARTITION BY {0}) - count(isFraud) OVER (PARTITION BY {0}, TransactionID % 5), 0)"
)
CTES |= {
    "history": f"""
        SELECT TransactionID, count(*) OVER h AS card1_tx_count, avg(TransactionAmt) OVER h AS card1_avg_amt,
            sqrt(CAST(count(u) OVER h * sum(u * u) OVER h - (sum(u) OVER h) * (sum(u) OVER h) AS DOUBLE)
                / nullif(CAST(count(u) OVER h * (count(u) OVER h - 1) AS DOUBLE), 0)) / 10000 AS card1_std_amt, avg(isFraud) OVER h AS card1_historical_fraud_rate
        FROM (SELECT *, CAST(round(TransactionAmt * 10000) AS HUGEINT) AS u FROM tx WHERE card1 IS NOT NULL) {_BEFORE}""",
    "folds": f"""
        SELECT TransactionID, CASE WHEN card1 IS NOT NULL THEN {_OTHERS.format("card1")} END AS card1_historical_fraud_rate,
            CASE WHEN P_emaildomain <> '' THEN {_OTHERS.format("P_emaildomain")} END AS email_domain_fraud_rate
        FROM tx""",
}
NEEDS |= {"history": ["tx"], "folds": ["tx"]}
_UNBIASED = [c for c in FEATURE_TABLE_COLUMNS if c != "amt_zscore_vs_card"]
_REPLACED = {
    "card1_tx_count": "h.card1_tx_count",
    "card1_avg_amt": "round(h.card1_avg_amt, 9)",
    "card1_std_amt": "round(h.card1_std_amt, 9)",
    "card1_historical_fraud_rate": "round(coalesce(h.card1_historical_fraud_rate, 0.035), 9)",
    "email_domain_fraud_rate": "round(coalesce(o.email_domain_fraud_rate, 0.035), 9)",
}
ORACLE |= {
    "card_history": _with(
        "history",
        """SELECT TransactionID, card1_tx_count, round(card1_avg_amt, 9) AS card1_avg_amt,
            round(card1_std_amt, 9) AS card1_std_amt,
            round(card1_historical_fraud_rate, 9) AS card1_historical_fraud_rate
            FROM tx LEFT JOIN history USING (TransactionID)""",
    ),
    "out_of_fold": _with(
        "folds", f"SELECT TransactionID, {_features(['card1_historical_fraud_rate', 'email_domain_fraud_rate'])} FROM folds"
    ),
    "stream_bounded": "SELECT count(*) // 2 AS taken, count(*) // 2 AS different FROM events",
}
CTES["unbiased"] = f"""
    SELECT {", ".join(f"{_REPLACED.get(c, 'f.' + c)} AS {c}" for c in _UNBIASED)}
    FROM feat f LEFT JOIN history h USING (TransactionID) JOIN folds o USING (TransactionID)"""
NEEDS["unbiased"] = ["feat", "history", "folds"]
ORACLE["unbiased_features"] = _with("unbiased", "SELECT * FROM unbiased")

# The same rows by other ways: files, tables and a stream in between
ORACLE |= {
    # a CSV file does not tell an empty text from a missing one
    "load_raw_join": f"""
        SELECT * REPLACE ({", ".join(f"nullif({c}, '') AS {c}" for c in ("P_emaildomain", "R_emaildomain", "DeviceType"))})
        FROM ({ORACLE["base_view"]})""",
    "feature_tables": ORACLE["train_split"],
    "stream_ingest": ORACLE["conform_schema"],
    "stream_dedup": ORACLE["conform_schema"],
    "ingest_ledger": ORACLE["conform_schema"],
    "ingest_compacted": ORACLE["conform_schema"],
    "ingest_counters": _with("routed", "SELECT route, count(*) AS messages FROM routed GROUP BY route"),
    "rebuilt_table": ORACLE["labelled_rows"],
    "stream_scores": ORACLE["score_requests"],
    "union_scores": _with(
        "feat",
        " UNION ALL ".join(
            f"SELECT TransactionID, '{name}' AS model, round({_fixed_score(name)}, 6) AS fraud_probability "
            "FROM feat WHERE isFraud IS NOT NULL"
            for name in bind.FIXED_SCORES
        ),
    ),
    "split_rows": _with(
        "feat",
        """SELECT CASE WHEN TransactionID % 10 < 8 THEN 'train' ELSE 'test' END AS split,
            count(*) AS n FROM feat GROUP BY 1""",
    ),
    "logistic_one_feature": _test_scores("logistic1", 5),
    "boosted_one_feature": _test_scores("boosted1", 9),
    "boosted_one_feature_scores": _with("boosted1", f"SELECT {SCORE_COLUMNS} FROM boosted1"),
    "boosted_one_feature_splits": _with(
        "weighted",
        "SELECT 'is_late_night' AS feature, CAST(count(*) - 1 AS DOUBLE) AS importance FROM weighted",
    ),
}

_TRAIN = "FROM feat WHERE isFraud IS NOT NULL AND TransactionID % 10 < 8"
# Two second-order steps of 0.3 from a margin of 0; pos and neg are the weighted labels of a leaf.
CTES["forest2"] = """
    SELECT f.*, m2.p, CAST(m2.p > 0.5 AS BIGINT) AS predicted FROM feat f JOIN (
        SELECT v, 1 / (1 + exp(-(m + 0.3 * (pos * (1 - q) - neg * q) / ((pos + neg) * q * (1 - q))))) AS p FROM (
            SELECT *, 1 / (1 + exp(-m)) AS q FROM (SELECT *, 0.3 * 2 * (pos - neg) / (pos + neg) AS m FROM weighted))
    ) m2 ON f.is_late_night = m2.v WHERE f.isFraud IS NOT NULL"""
NEEDS["forest2"] = ["weighted"]
ORACLE |= {
    "boosted_forest_two_rounds": _test_scores("forest2", 9),
    "category_codes": _with(
        "feat",
        " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{t}' AS feature, {t} AS value, count(*) AS n,
                CAST(row_number() OVER (ORDER BY count(*) DESC, {t}) - 1 AS INTEGER) AS code {_TRAIN} AND {t} <> ''
                GROUP BY {t} HAVING count(*) >= ceil(0.001 * (SELECT count(*) {_TRAIN}))) WHERE code < 198"""
            for t in TEXT_FEATURES
        ),
    ),
    "number_means": _with(
        "feat",
        "SELECT " + ", ".join(f"round(coalesce(avg({c}), 0.0), 6) AS {c}" for c in LOGISTIC_FEATURES if c not in TEXT_FEATURES)
        + f" {_TRAIN}",
    ),
}
