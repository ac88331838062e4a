"""The same queries as plain SQL for DuckDB, written independently of the Spark plans.

Where Spark works with run lengths, day windows and one fold, this SQL keeps every row, walks
through the outcome steps event by event in a recursive query, and joins ranges pairwise.
"""

from __future__ import annotations

import re

from partura.sources.driver_tables import CONCEPT_SET

# Fixed values, written out here so that a slip in the library's own tables shows.
SMALL_ID_QUERIES = ("start_ovul2_reference", "pregnancy_episodes")
GAP_COLUMNS = "LB SB DELIV TRO ECT AB SA".split()
GAPS = """
LB     182 168 168  70  70  70  70
SB     182 168 168  70  70  70  70
DELIV  182 168 168  70  70  70  70
TRO    168 154 154 730  56  56 365
ECT    168 154 154 365  56  56  56
AB     168 154 154 365  56  56  56
SA     168 154 154 365  56  56  56
"""
# Outcome: longest term, shortest term, days until the next can begin; default days of a preterm,
# postterm, fullterm and otherwise unknown start.
TERMS = """
LB     301 161  28  245 285 280 280
SB     301 100  28  196 285 280 196
DELIV  301 140  28  245 285 280 280
TRO    365  42  14   56  56  56  56
ECT     84  42  14   56  56  56  56
AB     168  42  14   70  70  70  70
SA     139  28  14   70  70  70  70
"""
# Evidence: records, days from record to start, which one is taken, rank.
STARTS = """
LMP      LMP                     0  latest     1
GEST     GEST                    -  latest     2
OVUL     OVUL                  -13  earliest   3
OVUL2    OVUL2                 -13  earliest   4
NULS     NULS                  -89  earliest   6
AFP      AFP                  -123  earliest   7
AMEN     AMEN                  -55  earliest  80
UP       UP                    -55  earliest  90
PUSHBACK PCONF,AGP,PCOMP,TA    -55  earliest   -
CONTRA   CONTRA                  0  latest     -
"""


def _table(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


def _values(rows) -> str:
    def literal(value):
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join(f"({', '.join(map(literal, row))})" for row in rows)


_gap_rows = [
    (first, later, int(days))
    for first, *row in _table(GAPS)
    for later, days in zip(GAP_COLUMNS, row, strict=True)
]
_term_rows = [(category, *map(int, row)) for category, *row in _table(TERMS)]
_gap_map = "MAP {" + ", ".join(f"'{f}>{l}': {d}" for f, l, d in _gap_rows) + "}"

CTES = {
    "rec": """
        SELECT o_custkey, o_custkey + 1000001 AS person_id, l_partkey AS k, l_linenumber AS ln,
               l_returnflag, l_linestatus, l_quantity,
               DATE '1995-01-01' + CAST(date_diff('day', DATE '1995-01-01',
                   CAST(l_shipdate AS DATE)) % 1461 AS INTEGER) AS d,
               o_custkey % 50 = 7 AS screening
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "condition_occurrence": """
        SELECT person_id, CASE WHEN screening THEN 0 ELSE 1000 + k % 20 END AS concept_id, d
        FROM rec WHERE ln IN (1, 2)""",
    "procedure_occurrence": """
        SELECT person_id, CASE WHEN screening THEN 0 ELSE 2000 + k % 12 END AS concept_id, d
        FROM rec WHERE ln = 3""",
    "observation": """
        SELECT person_id, CASE WHEN screening THEN 3003 ELSE 3000 + k % 6 END AS concept_id, d,
               l_returnflag AS txt, l_quantity AS num
        FROM rec WHERE ln = 4""",
    "measurement": """
        SELECT person_id, CASE WHEN screening THEN 0 ELSE 4000 + k % 6 END AS concept_id, d,
               l_linestatus AS txt, l_quantity AS num
        FROM rec WHERE ln = 5""",
    "drug_exposure": """
        SELECT person_id, 5000 + k % 40 AS concept_id, d FROM rec WHERE ln IN (6, 7)""",
    "drug_number": "SELECT DISTINCT p_partkey % 40 AS j FROM part",
    "concept": """
        SELECT 5000 + j AS concept_id, 'drug ' || j AS concept_name,
               CASE j % 6 WHEN 0 THEN 'Branded Drug' WHEN 1 THEN 'Branded Pack'
                          WHEN 2 THEN 'Clinical Drug' WHEN 3 THEN 'Clinical Pack'
                          WHEN 4 THEN 'Ingredient' ELSE 'Drug Class' END AS concept_class_id
        FROM drug_number""",
    "concept_ancestor": """
        SELECT 9001 + j % 3 AS ancestor_concept_id, 5000 + j AS descendant_concept_id
        FROM drug_number WHERE j < 30""",
    "person": """
        SELECT c_custkey + 1000001 AS person_id,
               CASE WHEN c_custkey % 8 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
               1935 + (7 * c_custkey) % 55 AS year_of_birth
        FROM customer""",
    "observation_period": """
        SELECT c_custkey + 1000001 AS person_id, DATE '1995-01-01' AS op_start,
               DATE '1996-12-31' AS op_end FROM customer WHERE c_custkey % 10 = 0
        UNION ALL
        SELECT c_custkey + 1000001, DATE '1997-01-01', DATE '1998-12-31'
        FROM customer WHERE c_custkey % 10 = 0
        UNION ALL
        SELECT c_custkey + 1000001, DATE '1995-01-01' + CAST(c_custkey % 200 AS INTEGER),
               DATE '1998-12-31' - CAST(c_custkey % 150 AS INTEGER)
        FROM customer WHERE c_custkey % 10 <> 0""",
    "concept_set": f"""
        SELECT concept_id, category, CAST(gest_value AS DOUBLE) AS gest_value, data_value
        FROM (VALUES {_values(CONCEPT_SET)}) t(concept_id, category, gest_value, data_value)""",
    "limits": f"""
        SELECT * FROM (VALUES {_values(_gap_rows)}) t(first_cat, later_cat, min_days)""",
    "terms": f"""
        SELECT * FROM (VALUES {_values(row[:4] for row in _term_rows)})
            t(category, max_term, min_term, retry)""",
    "gestation": f"""
        SELECT * FROM (VALUES {_values((row[0], *row[4:]) for row in _term_rows)})
            t(category, preterm, postterm, fullterm, nodata)""",
    # --- timeline
    "m_cond": """
        SELECT category, gest_value, person_id, d AS start_date, 'Cond' AS type,
               ' ' AS value_as_string, CAST(NULL AS DOUBLE) AS value_as_number
        FROM condition_occurrence JOIN concept_set USING (concept_id)""",
    "m_proc": """
        SELECT category, gest_value, person_id, d AS start_date, 'Proc' AS type,
               ' ' AS value_as_string, CAST(NULL AS DOUBLE) AS value_as_number
        FROM procedure_occurrence JOIN concept_set USING (concept_id)""",
    "m_obs": """
        SELECT category, gest_value, person_id, d AS start_date, 'Obs' AS type,
               txt AS value_as_string, num AS value_as_number
        FROM observation JOIN concept_set USING (concept_id) WHERE data_value IN ('N/A', txt)""",
    "m_meas": """
        SELECT category, gest_value, person_id, d AS start_date, 'Meas' AS type,
               txt AS value_as_string, num AS value_as_number
        FROM measurement JOIN concept_set USING (concept_id) WHERE data_value IN ('N/A', txt)""",
    "raw": """
        SELECT * FROM m_cond UNION ALL SELECT * FROM m_proc
        UNION ALL SELECT * FROM m_obs UNION ALL SELECT * FROM m_meas""",
    "raw_days": """
        SELECT person_id, category, start_date,
               CASE WHEN category <> 'GEST' THEN NULL
                    WHEN value_as_number IS NOT NULL THEN value_as_number * 7
                    ELSE gest_value * 7 END AS gest_value
        FROM raw""",
    "screened": """
        SELECT person_id FROM raw GROUP BY person_id
        HAVING count(DISTINCT category) = 1 AND max(category) = 'DIAB'""",
    "nondrug": """
        SELECT r.* FROM raw_days r ANTI JOIN screened USING (person_id)
        WHERE category <> 'GEST' OR gest_value <= 301""",
    "expansion": """
        SELECT c.concept_id, concept_name, s.category, s.gest_value
        FROM concept_set s JOIN concept_ancestor a ON s.concept_id = a.ancestor_concept_id
        JOIN concept c ON c.concept_id = a.descendant_concept_id
        WHERE s.category IN ('CONTRA', 'MTX', 'OVULDR') AND concept_class_id <> 'Drug Class'""",
    "drug": """
        SELECT person_id, category, d AS start_date, gest_value
        FROM drug_exposure JOIN expansion USING (concept_id)
        WHERE person_id IN (SELECT person_id FROM nondrug)""",
    "events": """
        SELECT person_id, category, start_date AS event_date, gest_value FROM nondrug
        UNION ALL SELECT person_id, category, start_date, gest_value FROM drug""",
    "tl": """
        SELECT person_id, row_number() OVER (PARTITION BY person_id
                   ORDER BY event_date, category, gest_value NULLS FIRST) AS event_id,
               category, event_date, gest_value
        FROM events""",
    # --- outcome selection, event by event
    "targets": """
        SELECT * FROM (VALUES ('LB', 1), ('SB', 2), ('ECT', 3), ('AB', 4), ('SA', 5), ('DELIV', 6))
            t(target, step)""",
    "universe": """
        SELECT target, category FROM targets,
            (SELECT first_cat AS category FROM limits UNION SELECT later_cat FROM limits)
        UNION SELECT target, category FROM targets, (VALUES ('AGP'), ('PCONF')) t(category)
            WHERE target <> 'LB'
        UNION SELECT 'ECT', category
            FROM (VALUES ('ECT_SURG1'), ('ECT_SURG2'), ('MTX')) t(category)""",
    "start_state": """
        SELECT person_id, list({'id': event_id, 'cat': category,
                   'd': date_diff('day', DATE '1970-01-01', event_date)} ORDER BY event_id) AS ev
        FROM tl
        WHERE category IN ('LB', 'SB', 'ECT', 'AB', 'SA', 'DELIV', 'AGP', 'PCONF',
                           'ECT_SURG1', 'ECT_SURG2', 'MTX')
        GROUP BY person_id""",
    "state": f"""
        SELECT person_id, 0 AS step, ev, list_filter(ev, lambda e: false) AS queue,
               list_filter(ev, lambda e: false) AS ok,
               CAST([] AS STRUCT(id BIGINT, cat VARCHAR, d BIGINT, good BOOLEAN,
                    seen STRUCT(id BIGINT, cat VARCHAR, d BIGINT)[], near BIGINT[])[]) AS log
        FROM start_state
        UNION ALL
        SELECT person_id, new_step, new_ev,
               CASE WHEN new_step > step
                    THEN list_sort(list_transform(list_filter(ev, lambda e: e.cat = target
                             AND len(list_filter(ev, lambda o: o.cat = e.cat AND o.d = e.d
                                                 AND o.id < e.id)) = 0),
                         lambda e: {{'d': e.d, 'id': e.id, 'cat': e.cat}})).list_transform(
                         lambda e: {{'id': e.id, 'cat': e.cat, 'd': e.d}})
                    WHEN target = 'LB'
                    THEN list_filter(queue[2:], lambda e: e.d - c.d + 1 >= gaps['LB>LB'])
                    ELSE queue[2:] END,
               CASE WHEN new_step = step AND (target = 'LB' OR (confirmed AND NOT active
                             AND NOT near))
                    THEN list_append(ok, {{'id': c.id, 'cat': c.cat, 'd': new_d}})
                    ELSE ok END,
               CASE WHEN new_step = step
                    THEN list_append(log, {{'id': c.id, 'cat': c.cat, 'd': new_d,
                        'good': target = 'LB' OR (confirmed AND NOT active AND NOT near),
                        'seen': ok, 'near': CASE WHEN target <> 'LB' THEN close ELSE [] END}})
                    ELSE log END
        FROM (
          SELECT *,
                 len(list_filter(new_ev, lambda e: e.cat IN ('AGP', 'PCONF')
                         AND e.d > new_d AND e.d <= new_d + 42)) > 0 AS active,
                 list_transform(list_filter(ok, lambda o: abs(o.d - new_d + 1) <
                         CASE WHEN o.d <= new_d THEN gaps[o.cat || '>' || c.cat]
                              ELSE gaps[c.cat || '>' || o.cat] END), lambda o: o.id) AS close,
                 len(close) > 0 AS near
          FROM (
            SELECT *, CASE WHEN new_step > step THEN ev ELSE list_transform(ev, lambda e:
                        CASE WHEN e.id = c.id THEN {{'id': e.id, 'cat': e.cat, 'd': new_d}}
                             ELSE e END) END AS new_ev
            FROM (
              SELECT *, coalesce(list_max(list_transform(list_filter(ev, lambda e:
                              e.d >= c.d AND e.d <= c.d + 14
                              AND ((target = 'ECT' AND e.cat IN ('ECT_SURG1', 'MTX'))
                                OR (target IN ('AB', 'SA') AND e.cat IN ('AB', 'SA')))),
                              lambda e: e.d)), c.d) AS new_d,
                     target <> 'ECT' OR len(list_filter(ev, lambda e:
                              e.cat IN ('ECT_SURG1', 'ECT_SURG2', 'MTX')
                              AND e.d >= c.d AND e.d <= c.d + 14)) > 0 AS confirmed
              FROM (
                SELECT *, queue[1] AS c,
                       CASE WHEN len(queue) = 0 THEN step + 1 ELSE step END AS new_step,
                       (['LB', 'SB', 'ECT', 'AB', 'SA', 'DELIV'])[
                           CASE WHEN len(queue) = 0 THEN step + 1 ELSE step END] AS target,
                       {_gap_map} AS gaps
                FROM state WHERE len(queue) > 0 OR step < 6))))""",
    "done": "SELECT person_id, ev, ok, log FROM state WHERE step = 6 AND len(queue) = 0",
    "turn": """
        SELECT person_id, l.cat AS target, l.id AS event_id, l.d, l.good, l.seen, l.near,
               CAST(row_number() OVER (PARTITION BY person_id, l.cat ORDER BY n) AS INTEGER) AS pass
        FROM (SELECT person_id, unnest(log) AS l, generate_subscripts(log, 1) AS n FROM done)""",
    "valid": """
        SELECT person_id, o.id AS event_id, o.cat AS category,
               DATE '1970-01-01' + CAST(o.d AS INTEGER) AS event_date
        FROM (SELECT person_id, unnest(ok) AS o FROM done)""",
    "moved": """
        SELECT person_id, e.id AS event_id, DATE '1970-01-01' + CAST(e.d AS INTEGER) AS new_date
        FROM (SELECT person_id, unnest(ev) AS e FROM done)""",
    "rtl": """
        SELECT person_id, event_id, category, coalesce(new_date, event_date) AS event_date,
               event_date AS first_date, gest_value
        FROM tl LEFT JOIN moved USING (person_id, event_id)""",
    # Events of types whose steps came before lie where they moved to.
    "pool": """
        SELECT u.target, r.person_id, min(r.event_id) AS event_id, r.category,
               CASE WHEN own.step < t.step THEN r.event_date ELSE r.first_date END AS event_date,
               r.gest_value
        FROM rtl r JOIN universe u USING (category) JOIN targets t ON t.target = u.target
        LEFT JOIN targets own ON own.target = r.category
        SEMI JOIN (SELECT DISTINCT person_id, category FROM tl) h
            ON h.person_id = r.person_id AND h.category = u.target
        GROUP BY ALL""",
    "pool_left": """
        SELECT p.target, p.person_id, p.event_id, k.passes,
               min(x.pass) FILTER (CASE WHEN p.target = 'LB'
                   THEN date_diff('day', DATE '1970-01-01', p.event_date) - x.d + 1 < l.min_days
                   ELSE x.event_id = p.event_id END) AS gone
        FROM pool p JOIN turn x USING (person_id, target)
        JOIN (SELECT person_id, target, max(pass) AS passes FROM turn GROUP BY ALL) k
            USING (person_id, target)
        LEFT JOIN limits l ON l.first_cat = 'LB' AND l.later_cat = p.category
        GROUP BY ALL""",
    # The one event that stands for equal outcome events.
    "heads": """
        SELECT r.* FROM rtl r JOIN (
            SELECT person_id, min(event_id) AS event_id FROM tl
            WHERE category IN ('LB', 'SB', 'ECT', 'AB', 'SA', 'DELIV')
            GROUP BY person_id, category, event_date) USING (person_id, event_id)""",
    # --- starts
    "prior": """
        SELECT o.person_id, o.event_id, max(p.event_date) AS prior_outcome_date,
               arg_max(p.category, p.event_date) AS prior_category
        FROM valid o LEFT JOIN valid p
            ON p.person_id = o.person_id AND p.event_date < o.event_date
        GROUP BY ALL""",
    "bounds": """
        SELECT v.*, p.prior_outcome_date, p.prior_category, max_term, retry,
               v.event_date - min_term AS hi,
               greatest(p.prior_outcome_date + retry, v.event_date - max_term) AS lo
        FROM valid v JOIN prior p USING (person_id, event_id) JOIN terms USING (category)""",
    "marks": """
        SELECT b.person_id, b.event_id,
               count(*) FILTER (WHERE r.category = 'PREM') AS pre_count,
               count(*) FILTER (WHERE r.category = 'POSTT') AS post_count,
               count(*) FILTER (WHERE r.category = 'FT') AS full_count
        FROM bounds b JOIN rtl r ON r.person_id = b.person_id
            AND r.event_date >= greatest(prior_outcome_date, b.event_date - max_term)
            AND r.event_date <= b.event_date + 30
        GROUP BY ALL""",
    "s_default": """
        SELECT person_id, event_id,
               greatest(prior_outcome_date + t.retry, event_date - CASE
                   WHEN pre_count > 0 THEN preterm WHEN full_count > 0 THEN fullterm
                   ELSE nodata END) AS episode_start_date,
               CASE WHEN pre_count > 0 THEN 'PREM' ELSE 'DEFAULT' END AS category,
               99 AS date_rank
        FROM bounds b JOIN marks USING (person_id, event_id) JOIN gestation USING (category)
        LEFT JOIN terms t ON t.category = b.prior_category""",
}


def _start(row: list[str], lo: str = "b.lo", extra: str = "") -> str:
    """One kind of evidence by a range join and the pick of one row per outcome."""
    name, records, days, pick, rank = row
    shift = "CAST(trunc(1 - r.gest_value) AS INTEGER)" if days == "-" else f"({days})"
    categories = ", ".join(f"'{c}'" for c in records.split(","))
    order = "r.event_date DESC, s DESC" if pick == "latest" else "s"
    rank = "CAST(NULL AS INTEGER)" if rank == "-" else rank
    return f"""
        SELECT person_id, event_id, s AS episode_start_date, '{name}' AS category,
               {rank} AS date_rank
        FROM (SELECT b.person_id, b.event_id, r.event_date + {shift} AS s,
                     row_number() OVER (PARTITION BY b.person_id, b.event_id
                                        ORDER BY {order}) AS pick
              FROM bounds b JOIN rtl r ON r.person_id = b.person_id {extra}
              WHERE r.category IN ({categories})
                AND r.event_date + {shift} BETWEEN {lo} AND b.hi)
        WHERE pick = 1"""


_starts = {row[0]: row for row in _table(STARTS)}
for _name, _row in _starts.items():
    CTES[f"s_{_name.lower()}"] = _start(_row)
CTES["s_ovul2_reference"] = _start(
    _starts["OVUL2"],
    lo="greatest(q.prior_outcome_date + b.retry, b.event_date - b.max_term)",
    extra="JOIN prior q ON q.person_id = q.event_id AND q.event_id = b.event_id",
)

CTES |= {
    "ranked": " UNION ".join(
        f"SELECT * FROM s_{name}"
        for name in ("lmp", "gest", "ovul", "ovul2_reference", "nuls", "afp", "amen", "up", "default")
    ),
    "best": """
        SELECT * FROM ranked
        QUALIFY row_number() OVER (PARTITION BY person_id, event_id ORDER BY date_rank) = 1""",
    "refined": """
        SELECT person_id, event_id,
               CASE WHEN pc IS NULL AND cc IS NULL THEN bs
                    WHEN cc IS NULL THEN least(pc, bs)
                    WHEN pc IS NULL THEN greatest(cc, bs)
                    WHEN pc < bs AND cc < pc THEN pc
                    WHEN pc < bs AND cc > pc THEN cc
                    WHEN pc > bs AND cc > bs THEN cc
                    ELSE bs END AS episode_start_date,
               category || ':REFINED' AS category, date_rank - 1 AS date_rank
        FROM (SELECT b.*, b.episode_start_date AS bs, p.episode_start_date AS pc,
                     c.episode_start_date AS cc
              FROM best b LEFT JOIN s_pushback p USING (person_id, event_id)
              LEFT JOIN s_contra c USING (person_id, event_id) WHERE b.date_rank > 7)""",
    # --- episodes
    "candidates": """
        SELECT v.person_id, s.episode_start_date, v.event_date AS episode_end_date,
               s.category AS start_category, v.category AS outcome_category, s.date_rank AS rank
        FROM valid v JOIN (SELECT * FROM ranked UNION SELECT * FROM refined) s
            USING (person_id, event_id)""",
    "chosen": """
        SELECT * EXCLUDE (rank) FROM candidates
        QUALIFY row_number() OVER (PARTITION BY person_id, episode_end_date ORDER BY rank) = 1""",
    "in_period": """
        SELECT c.* FROM chosen c JOIN observation_period o ON o.person_id = c.person_id
            AND episode_end_date BETWEEN op_start AND op_end AND episode_start_date >= op_start""",
    "of_age": """
        SELECT i.* FROM in_period i JOIN person USING (person_id)
        WHERE gender_concept_id = 8532
            AND year(episode_start_date) - year_of_birth BETWEEN 12 AND 55""",
    "counted": """
        SELECT *, CAST(row_number() OVER (PARTITION BY person_id ORDER BY episode_start_date,
                   episode_end_date, outcome_category) AS INTEGER) AS episode
        FROM of_age""",
    "supported": """
        SELECT c.* FROM counted c SEMI JOIN (
            SELECT c.person_id, c.episode
            FROM counted c JOIN terms t ON t.category = c.outcome_category
            JOIN rtl r ON r.person_id = c.person_id
                AND r.event_date BETWEEN episode_end_date - max_term + 1 AND episode_end_date
            GROUP BY ALL HAVING count(r.event_id) >= 2) USING (person_id, episode)""",
    "final": """
        SELECT person_id, episode_start_date, episode_end_date, start_category AS start_method,
               outcome_category AS original_outcome, episode,
               CASE WHEN outcome_category IN ('AB', 'SA') THEN 'SA/AB'
                    WHEN outcome_category IN ('DELIV', 'LB') THEN 'LB/DELIV'
                    WHEN outcome_category = 'SB' AND days < 140 THEN 'SA/AB'
                    ELSE outcome_category END AS outcome,
               days AS episode_length
        FROM (SELECT *, CAST(date_diff('day', episode_start_date, episode_end_date) + 1
                             AS INTEGER) AS days
              FROM supported)""",
}

_WINDOW_14 = """
    SELECT h.person_id, h.event_id, max(r.{date}) AS {name},
           CAST(max(date_diff('day', h.first_date, r.{date})) AS INTEGER) AS date_difference
    FROM heads h JOIN rtl r ON r.person_id = h.person_id
        AND r.{date} BETWEEN h.first_date AND h.first_date + 14
    WHERE h.category = '{target}' AND r.category IN ({by}) GROUP BY ALL"""

_LB = "(SELECT * FROM valid WHERE category = 'LB')"

FINAL = {
    "cdm_scan_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}"
        for name, source in [
            *[(t, t) for t in ("condition_occurrence", "procedure_occurrence", "observation",
                               "measurement", "drug_exposure", "concept", "concept_ancestor",
                               "observation_period", "person")],
            ("pregnancy_concepts", "concept_set"),
        ]
    ),
    "concept_match_condition": "SELECT * EXCLUDE (value_as_string, value_as_number) FROM m_cond",
    "concept_match_procedure": "SELECT * EXCLUDE (value_as_string, value_as_number) FROM m_proc",
    "concept_match_observation": "SELECT * FROM m_obs",
    "concept_match_measurement": "SELECT * FROM m_meas",
    "raw_events": "SELECT * FROM raw",
    "gest_days": "SELECT * FROM raw_days",
    "exclude_single_category": "SELECT * FROM screened",
    "events_nondrug": "SELECT * FROM nondrug",
    "concept_expansion": "SELECT CAST(concept_id AS INTEGER) AS concept_id, concept_name, category,"
    " gest_value FROM expansion",
    "events_drug": "SELECT * FROM drug",
    "events_all": "SELECT * FROM events",
    "event_timeline": "SELECT * FROM tl",
    "target_people": """
        SELECT DISTINCT target, person_id FROM tl JOIN targets ON target = category""",
    "category_universe": """
        SELECT target, category, count(*) AS n_events FROM tl JOIN universe USING (category)
        GROUP BY ALL""",
    "dedupe_events": "SELECT * FROM pool",
    "next_outcome": "SELECT target, pass, person_id, event_id FROM turn",
    "min_gap_delete": """
        SELECT target, gone AS pass, person_id, event_id FROM pool_left
        WHERE target = 'LB' AND gone IS NOT NULL""",
    "valid_lb": "SELECT person_id, event_id FROM valid WHERE category = 'LB'",
    "rule_out_active": """
        SELECT person_id, event_id, category FROM heads h
        WHERE category <> 'LB' AND EXISTS (SELECT 1 FROM rtl r WHERE r.person_id = h.person_id
            AND r.category IN ('AGP', 'PCONF')
            AND r.event_date > h.event_date AND r.event_date <= h.event_date + 42)""",
    "prior_flag": """
        SELECT target, pass, person_id, event_id, o.id AS accepted_event_id,
               CASE WHEN o.d <= d THEN 1 ELSE 0 END AS prior
        FROM (SELECT *, unnest(seen) AS o FROM turn WHERE target <> 'LB')""",
    "min_gap_conflict": """
        SELECT target, pass, person_id, event_id, unnest(near) AS accepted_event_id FROM turn""",
    "accept_outcome": "SELECT target, pass, person_id, event_id FROM turn WHERE good",
    "outcome_decisions": """
        SELECT t.target, t.pass, t.person_id, t.event_id, t.good AS accepted,
               DATE '1970-01-01' + CAST(t.d AS INTEGER) AS event_date,
               t.near[1] AS conflicting_event_id,
               (SELECT arg_min(r.event_id, {'d': r.event_date, 'e': r.event_id}) FROM tl r
                WHERE r.person_id = t.person_id AND r.category IN ('AGP', 'PCONF')
                    AND t.target <> 'LB'
                    AND date_diff('day', DATE '1970-01-01', r.event_date) - t.d BETWEEN 1 AND 42
               ) AS refuting_event_id,
               (SELECT arg_max(r.event_id, {'d': r.event_date, 'e': -r.event_id}) FROM tl r
                WHERE r.person_id = t.person_id AND t.target = 'ECT'
                    AND r.category IN ('ECT_SURG1', 'ECT_SURG2', 'MTX')
                    AND date_diff('day', h.event_date, r.event_date) BETWEEN 0 AND 14
               ) AS confirming_event_id
        FROM turn t JOIN tl h USING (person_id, event_id)""",
    "accept_ect": "SELECT person_id, event_id FROM valid WHERE category = 'ECT'",
    "ect_confirmation": _WINDOW_14.format(
        date="event_date", name="confirmation_date", target="ECT",
        by="'ECT_SURG1', 'ECT_SURG2', 'MTX'",
    ),
    "ect_revised_date": _WINDOW_14.format(
        date="event_date", name="revised_date", target="ECT", by="'ECT_SURG1', 'MTX'"
    ),
    **{
        f"{target.lower()}_revised_date": f"""
            SELECT person_id, event_id, event_date AS revised_date,
                   CAST(date_diff('day', first_date, event_date) AS INTEGER) AS date_difference
            FROM heads WHERE category = '{target}'"""
        for target in ("AB", "SA")
    },
    "revised_timeline": "SELECT * EXCLUDE (first_date) FROM rtl",
    "pool_remaining": """
        SELECT target, CAST(pass AS INTEGER) AS pass, person_id, event_id
        FROM (SELECT *, unnest(range(1, coalesce(gone - 1, passes) + 1)) AS pass FROM pool_left)""",
    "valid_outcomes": "SELECT person_id, event_id FROM valid",
    "outcome_events": "SELECT * FROM valid",
    "prior_outcome_asof": "SELECT * FROM prior",
    "term_marker_counts": "SELECT * FROM marks",
    "start_default": "SELECT * FROM s_default",
    "all_starts": "SELECT * FROM ranked",
    "best_start": "SELECT * FROM best",
    "refined_start": "SELECT * FROM refined",
    "episode_all_starts": "SELECT * FROM candidates",
    "episode_best": "SELECT * FROM chosen",
    "episode_enrolled": "SELECT * FROM in_period",
    "episode_eligible": "SELECT * FROM of_age",
    "episode_numbered": "SELECT * FROM counted",
    "episode_two_events": "SELECT * FROM supported",
    "pregnancy_episodes": "SELECT * FROM final",
    "lookup_outcome_limit": """
        SELECT person_id, event_id, prior_category, category, min_days,
               CAST(date_diff('day', prior_outcome_date, event_date) AS INTEGER) AS days
        FROM valid JOIN prior USING (person_id, event_id)
        JOIN limits ON first_cat = prior_category AND later_cat = category""",
    "lookup_term_durations": """
        SELECT category, person_id, event_id, max_term, min_term, retry
        FROM heads JOIN terms USING (category)""",
    "lookup_gest_est": """
        SELECT category, person_id, event_id, preterm, postterm, fullterm, nodata
        FROM heads JOIN gestation USING (category)""",
    "lookup_outcome_limit_use": """
        SELECT first_cat AS prior_category, later_cat AS category, min_days,
               (SELECT count(*) FROM valid v JOIN prior p USING (person_id, event_id)
                WHERE p.prior_category = first_cat AND v.category = later_cat) AS n_outcomes
        FROM limits""",
    **{
        f"lookup_{name}_use": f"""
            SELECT t.*, (SELECT count(*) FROM valid v WHERE v.category = t.category) AS n_outcomes
            FROM {cte} t"""
        for name, cte in (("term_durations", "terms"), ("gest_est", "gestation"))
    },
    **{
        f"start_{name}": f"SELECT * FROM s_{cte}"
        for name, cte in [
            *[(n, n) for n in ("lmp", "gest", "ovul", "nuls", "afp", "amen", "up", "pushback",
                               "contra")],
            ("ovul2_reference", "ovul2_reference"),
            ("ovul2_corrected", "ovul2"),
        ]
    },
}


def _needed(sql: str) -> list[str]:
    """Names of the CTEs a statement uses, directly or not, in order of definition."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", re.sub(r"'[^']*'", "", todo.pop())))
        for name in (words & CTES.keys()) - found:
            found.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in found]


def all_oracles() -> dict[str, str]:
    def statement(final: str) -> str:
        ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(final))
        return f"WITH RECURSIVE {ctes}\n{final}"

    statements = {name: statement(final) for name, final in FINAL.items()}
    for name in ("valid_outcomes", "pregnancy_episodes"):
        statements[f"{name}_early"] = statements[name]
    for name in SMALL_ID_QUERIES:
        statements[f"{name}_small_ids"] = statements[name].replace("+ 1000001", "+ 0")
    return statements
