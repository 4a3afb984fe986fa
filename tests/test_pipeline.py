from __future__ import annotations

from datetime import timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bankpulse import schemas
from bankpulse.operators.activity import v_account_activity
from bankpulse.operators.constraints import single_period_row
from bankpulse.operators.integrity import QualityGateError, integrity_checks, quality_gate
from bankpulse.operators.measures import measures
from bankpulse.operators.monthly import v_monthly_kpis
from bankpulse.operators.ordering import working_folder
from bankpulse.operators.star import Star, calendar, states
from bankpulse.plans import pipeline
from bankpulse.plans.named import NAMED, run_query
from bankpulse.sources.files import (
    read_crm_csv, read_typed_csv, rejected_crm_lines, rejected_lines, write_crm_csv, write_typed_csv,
)
from bankpulse.sources.layer import LayerTables, published_runs, read_star
from bankpulse.vocabulary import CHECK_LABELS, NOT_SEGMENTED


def failing(tables):
    keys = {label: key for key, label in CHECK_LABELS.items()}
    return {keys[row.check_name]: row.failing_rows for row in integrity_checks(tables).collect() if row.failing_rows}


def test_a_clean_journey_passes_the_gate(spark, journey):
    assert failing(journey.tables(spark)) == {}
    quality_gate(journey.tables(spark))


def edit(rows, index, **changes):
    row = list(rows[index])
    for position, value in changes.items():
        row[int(position[1:])] = value
    rows[index] = tuple(row)


@pytest.mark.parametrize("name, damage", [
    ("chk_balance_vs_flows", lambda j: edit(j.accounts, 0, _4=Decimal("150.01"))),
    ("chk_luhn", lambda j: edit(j.accounts, 2, _2="4000007916053703")),
    ("chk_card_duplicates", lambda j: edit(j.accounts, 2, _2=j.accounts[0][2])),
    ("chk_txn_vs_operation", lambda j: edit(j.operations, 4, _6=Decimal("251.00"))),
    ("chk_op_without_txn", lambda j: j.operations.append((11, 3, "DEPOSIT", "SUCCESS", None, "APP", Decimal(1), j.operations[5][7]))),
    ("chk_op_before_opening", lambda j: edit(j.operations, 3, _7=j.operations[0][7] - timedelta(days=9))),
    ("chk_success_after_close", lambda j: j.operations.append((11, 2, "LOGIN", "SUCCESS", None, "APP", None, j.operations[9][7]))),
])
def test_each_check_finds_its_damage(spark, journey, name, damage):
    damage(journey)
    assert failing(journey.tables(spark)) == {name: 1}
    with pytest.raises(QualityGateError):
        quality_gate(journey.tables(spark))


def test_an_unknown_amount_is_not_a_difference(spark, journey):
    edit(journey.operations, 4, _6=None)
    assert failing(journey.tables(spark)) == {}


def test_account_view(spark, journey, params):
    rows = {row.account_id: row for row in v_account_activity(journey.tables(spark), params).collect()}
    assert [rows[i].lifecycle_status for i in (1, 2, 3)] == ["ACTIVE", "CLOSED", "NEVER_FUNDED"]
    alice = rows[1]
    assert (alice.total_deposits, alice.transfers_sent, alice.balance_at_period_end) == (250, 100, 150)
    assert (alice.failed_operations, alice.logins, alice.days_to_first_deposit) == (3, 0, 330)
    assert (alice.age_at_opening, alice.age_band, rows[3].age_band) == (34, "25-34", "Inconnu")
    assert rows[2].transfers_received == 100 and rows[2].withdrawals == 100


def test_operations_after_the_period_change_nothing(spark, journey, params):
    before = v_account_activity(journey.tables(spark), params).collect()
    later = params.period_end + timedelta(seconds=1)
    journey.operations.append((50, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(9), later))
    journey.transactions.append((50, 50, "DEPOSIT", None, 1, Decimal(9), None, later))
    assert sorted(v_account_activity(journey.tables(spark), params).collect()) == sorted(before)


def test_dormancy_bound_is_inclusive(spark, journey, params):
    bound = params.period_end - timedelta(days=90)
    journey.operations = [op for op in journey.operations if op[1] != 1 or op[2] == "CREATE_ACCOUNT"]
    journey.operations.append((60, 1, "DEPOSIT", "SUCCESS", None, "APP", Decimal(9), bound))
    status = v_account_activity(journey.tables(spark), params).where("account_id = 1").first().lifecycle_status
    journey.operations[-1] = (*journey.operations[-1][:7], bound - timedelta(seconds=1))
    earlier = v_account_activity(journey.tables(spark), params).where("account_id = 1").first().lifecycle_status
    journey.operations[-1] = (60, 1, "DEPOSIT", "SUCCESS", None, "SEPA", Decimal(9), bound)
    salary = v_account_activity(journey.tables(spark), params).where("account_id = 1").first()
    assert (status, earlier, salary.lifecycle_status) == ("ACTIVE", "DORMANT", "DORMANT")
    assert salary.last_activity_at is None


def test_month_spine_is_dense(spark, journey, params):
    rows = {row.month_start.month: row for row in v_monthly_kpis(journey.tables(spark), params).collect()}
    assert len(rows) == 12
    assert (rows[1].new_accounts, rows[2].new_accounts, rows[12].closed_accounts) == (3, 0, 1)
    assert rows[2].app_failure_rate_pct is None and rows[12].app_failure_rate_pct == Decimal("50.00")


def test_calendar_has_every_month_with_labels(spark):
    span = spark.sql("SELECT date'2025-01-01' AS first, date'2026-06-01' AS last")
    rows = calendar(span).orderBy("Mois").collect()
    assert len(rows) == 18
    assert (rows[0]["Libellé mois"], rows[-1]["Libellé mois"]) == ("janv. 2025", "juin 2026")
    assert rows[4]["Trimestre"] == "T2 2025"
    orders = [row["Ordre mois"] for row in rows]
    assert orders == sorted(set(orders))


def deliver(spark, journey, folder):
    tables = journey.tables(spark)
    write_crm_csv(tables.staging(), f"{folder}/customers_crm_export.csv")
    write_typed_csv(tables.accounts_with_balance(), f"{folder}/accounts.csv")
    write_typed_csv(tables.operation_log(), f"{folder}/operation_log.csv")
    write_typed_csv(tables.transactions(), f"{folder}/transactions.csv")


def test_full_rebuild_from_files(spark, journey, params, tmp_path):
    deliver(spark, journey, tmp_path / "in")
    layer, star = str(tmp_path / "layer"), str(tmp_path / "star")
    counts = pipeline.run(spark, "all", str(tmp_path / "in"), layer, star, params)
    assert counts["stg_customers_raw"] == 4 and counts["customers"] == 3 and counts["operation_log"] == 10
    assert counts["dim_compte"] == 3 and counts["dim_mois"] == 12 and counts["dim_canal"] == 4
    for name in schemas.STAR:
        assert read_star(spark, star, name).count() == counts[name]
    again = v_account_activity(LayerTables(spark, layer), params).collect()
    assert sorted(again) == sorted(v_account_activity(journey.tables(spark), params).collect())


def test_the_gate_stops_the_rebuild(spark, journey, params, tmp_path):
    edit(journey.accounts, 0, _4=Decimal("1.00"))
    deliver(spark, journey, tmp_path / "in")
    with pytest.raises(QualityGateError):
        pipeline.run(spark, "all", str(tmp_path / "in"), str(tmp_path / "layer"), str(tmp_path / "star"), params)
    assert not (tmp_path / "star").exists()
    with pytest.raises(FileNotFoundError):
        LayerTables(spark, str(tmp_path / "layer"))


def test_a_failed_run_leaves_the_published_layer(spark, journey, params, tmp_path, monkeypatch):
    delivery, layer, star = (str(tmp_path / name) for name in ("in", "layer", "star"))
    deliver(spark, journey, tmp_path / "in")
    pipeline.run(spark, "all", delivery, layer, star, params)
    reader = LayerTables(spark, layer)
    wanted = sorted(v_account_activity(reader, params).collect())
    exported = {name: sorted(map(str, read_star(spark, star, name).collect())) for name in schemas.STAR}

    def unchanged():
        assert LayerTables(spark, layer).folder == reader.folder
        assert sorted(v_account_activity(LayerTables(spark, layer), params).collect()) == wanted
        assert exported == {name: sorted(map(str, read_star(spark, star, name).collect())) for name in schemas.STAR}

    edit(journey.accounts, 0, _4=Decimal("1.00"))
    deliver(spark, journey, tmp_path / "in")
    with pytest.raises(QualityGateError):  # at the gate
        pipeline.run(spark, "all", delivery, layer, star, params)
    unchanged()
    edit(journey.accounts, 0, _4=Decimal("150.00"))
    journey.operations.append((70, 1, "LOGIN", "SUCCESS", None, "APP", None, journey.operations[4][7]))
    deliver(spark, journey, tmp_path / "in")
    with monkeypatch.context() as broken:  # in the middle of the load
        broken.setattr("bankpulse.sources.layer.stamped", lambda staging: staging.select("no such column"))
        with pytest.raises(Exception, match="no such column"):
            pipeline.run(spark, "load", delivery, layer, star, params)
    unchanged()
    with open(tmp_path / "in" / "transactions.csv" / "extra.csv", "w") as more:
        more.write("transaction_id,operation_id,txn_type,from_account_id,to_account_id,amount,merchant_category,created_at\nx,,,,,,,\n1,2\n")
    counts = pipeline.run(spark, "load", delivery, layer, star, params)
    assert counts["rejected_lines"] == 2 and LayerTables(spark, layer).folder != reader.folder
    assert LayerTables(spark, layer).operation_log().count() == 1 + reader.operation_log().count()
    pipeline.run(spark, "load", delivery, layer, star, params)
    kept = [f for f in (tmp_path / "layer").iterdir() if f.name.startswith("run-") and (f / "transactions").exists()]
    assert len(published_runs(spark, layer)) == 3 and {f.name for f in kept} >= set(published_runs(spark, layer)[:2])
    assert not (tmp_path / "layer" / published_runs(spark, layer)[2]).exists()


def test_states_add_up(spark, journey, params):
    """Facts of written states, and of states of parts of the log, are those of the log."""
    plain = Star(journey.tables(spark), params)
    for star in (plain.with_steps(), Star(journey.tables(spark), params)):
        halves = [states(star.operations.where(F.col("status") == s), "attempts") for s in ("SUCCESS", "FAILED")]
        star.operations = halves[0].union(halves[1])
        for name in ("dim_mois", "fait_activite_mensuelle", "fait_operations", "fait_depenses_carte", "fait_retention_cohortes"):
            assert sorted(map(str, getattr(star, name).collect())) == sorted(map(str, getattr(plain, name).collect()))
    assert plain.dim_compte is plain.dim_compte


def test_month_folders_outside_the_period_are_skipped(spark, journey, params, tmp_path):
    deliver(spark, journey, tmp_path / "in")
    pipeline.run(spark, "load", str(tmp_path / "in"), str(tmp_path / "layer"), "", params)
    plan = LayerTables(spark, str(tmp_path / "layer")).operation_log(until=params.period_end)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text
    assert "PushedFilters: [IsNotNull(created_at), LessThanOrEqual(created_at" in text


def test_empty_csv_fields_stay_empty_text(spark, tmp_path):
    (tmp_path / "crm.csv").write_text(
        "crm_customer_id;first_name;last_name;email;birth_date;city;signup_channel;updated_at\n"
        " 1;Zoé ;Petit;;;Lyon;web;2025-01-01 00:00:00\n", encoding="utf-8")
    row = read_crm_csv(spark, str(tmp_path / "crm.csv")).first()
    assert (row.crm_customer_id, row.first_name, row.email, row.birth_date) == (" 1", "Zoé ", "", "")


def test_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "crm.csv").write_text(
        "first_name;crm_customer_id;last_name;email;birth_date;city;signup_channel;updated_at;extra\n"
        'Zoé;1;"Petit ""la; grande""";;;Lyon;web;2025-01-01 00:00:00;x\n', encoding="utf-8")
    row = read_crm_csv(spark, str(tmp_path / "crm.csv")).first()
    assert (row.crm_customer_id, row.first_name, row.last_name) == ("1", "Zoé", 'Petit "la; grande"')
    (tmp_path / "typed.csv").write_text("b,a\n2025-01-01 10:00:00,7\n,\n", encoding="utf-8")
    rows = read_typed_csv(spark, str(tmp_path / "typed.csv"), "a bigint, b timestamp_ntz").collect()
    assert [(r.a, str(r.b)) for r in rows] == [(7, "2025-01-01 10:00:00"), (None, "None")]
    (tmp_path / "bad.csv").write_text("a,b\nseven,2025-01-01 10:00:00\n", encoding="utf-8")
    assert read_typed_csv(spark, str(tmp_path / "bad.csv"), "a bigint, b timestamp_ntz").count() == 0
    with pytest.raises(ValueError, match="no column"):
        read_typed_csv(spark, str(tmp_path / "bad.csv"), "a bigint, c bigint")


def test_files_of_a_folder_keep_their_own_header(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b,note\n1,2.50,x\n3,,\"two\nlines, one \"\"field\"\"\"\n", encoding="utf-8")
    (folder / "2.csv").write_text("b,note,a\n7.25,y,5\n8.00,6\n9.00,z,six\n1,2,3,4\n", encoding="utf-8")
    (folder / "3.csv").write_text("\ufeffnote,a,b\nz,9,0.5\n", encoding="utf-8")
    (folder / "4.csv").write_text("", encoding="utf-8")
    schema = "a bigint, b decimal(8,2), note string"
    rows = sorted(tuple(r) for r in read_typed_csv(spark, str(folder), schema, line_breaks=True).collect())
    assert rows == [
        (1, Decimal("2.50"), "x"), (3, None, 'two\nlines, one "field"'), (5, Decimal("7.25"), "y"), (9, Decimal("0.50"), "z"),
    ]
    rejects = rejected_lines(spark, str(folder), schema, line_breaks=True).collect()
    assert sorted((r.reason, r.line) for r in rejects) == [("WRONG_LENGTH", "1,2,3,4"), ("WRONG_LENGTH", "8.00,6"), ("WRONG_TYPE", "six,9.00,z")]
    assert {r.file.rsplit("/", 1)[1] for r in rejects} == {"2.csv"} and rejected_lines(spark, str(folder), schema, True).count() == 3
    assert read_typed_csv(spark, [str(folder / "1.csv"), str(folder / "3.csv")], schema, True).count() == 3


def test_lines_the_crm_export_cannot_be_read_from(spark, tmp_path):
    header = "crm_customer_id;first_name;last_name;email;birth_date;city;signup_channel;updated_at"
    (tmp_path / "a.csv").write_text(f'{header}\n1;"Zoé;\nAnne";Petit;;;Lyon;web;2025-01-01 00:00:00\n2;short\n', encoding="utf-8")
    backwards = ";".join(reversed(header.split(";")))
    (tmp_path / "b.csv").write_text(f"{backwards}\n2025-01-02 00:00:00;web;Lyon;;;Durand;Bob;3\n", encoding="utf-8")
    rows = sorted((r.crm_customer_id, r.first_name, r.last_name, r.birth_date) for r in read_crm_csv(spark, str(tmp_path)).collect())
    assert rows == [("1", "Zoé;\nAnne", "Petit", ""), ("3", "Bob", "Durand", "")]
    assert [(r.reason, r.line) for r in rejected_crm_lines(spark, str(tmp_path)).collect()] == [("WRONG_LENGTH", "2;short")]


def test_rebuild_twice(spark, journey, params, tmp_path):
    folder = Path(working_folder(spark).removeprefix("file:"))
    for _ in range(2):
        deliver(spark, journey, tmp_path / "in")
        before = set(folder.iterdir())
        counts = pipeline.run(spark, "all", str(tmp_path / "in"), str(tmp_path / "layer"), str(tmp_path / "star"), params)
        assert set(folder.iterdir()) == before  # written steps are gone with the run
    assert read_star(spark, str(tmp_path / "star"), "dim_compte").count() == counts["dim_compte"] == 3


def test_period_row(spark, journey, params):
    assert single_period_row(journey.tables(spark), params).first().violations == 0


def test_measures_follow_the_relationships(spark, journey, params):
    star = Star(journey.tables(spark), params)
    by_quarter = {r["Trimestre"]: r.tentatives for r in measures(star, ["tentatives"], ["Trimestre"]).collect()}
    assert by_quarter == {"T1 2025": 3, "T4 2025": 7}
    assert {r["Canal"]: r.comptes for r in measures(star, ["comptes"], ["Canal"]).collect()} == {"Mobile": 1, "Site web": 1, "Partenaires": 1}
    by_age = {r["Tranche âge"]: r.comptes_actifs_du_mois for r in measures(star, ["comptes_actifs_du_mois"], ["Tranche âge"]).collect()}
    assert by_age["25-34"] == 1
    assert sum(r.comptes for r in measures(star, ["comptes"], ["Segment RFM"]).collect()) == 3
    last = {r["Trimestre"]: r.comptes_actifs_dernier_mois for r in measures(star, ["comptes_actifs_dernier_mois"], ["Trimestre"]).collect()}
    assert last["T4 2025"] == 2 and measures(star, ["comptes_actifs_dernier_mois"]).first()[0] == 2
    by_month = measures(star, ["comptes_actifs_dernier_mois"], ["Mois"]).collect()
    assert len(by_month) == measures(star, ["comptes_actifs_du_mois"], ["Mois"]).count() > 1
    share = measures(star, ["part_des_comptes_segmentes"]).first()[0]
    segmented = sum(r.comptes for r in measures(star, ["comptes"], ["Segment RFM"]).collect() if r["Segment RFM"] != NOT_SEGMENTED)
    assert share == round(Decimal(3) / segmented, 6)
    with pytest.raises(ValueError, match="calendar"):
        measures(star, ["encours"], ["Trimestre"])


def test_views_and_named_queries(spark, journey, params):
    tables = journey.tables(spark)
    pipeline.register_views(tables, params)
    assert spark.sql("SELECT count(*) FROM v_account_activity v JOIN customers USING (customer_id)").first()[0] == 3
    assert len(NAMED) == 20
    assert run_query("q01_global_kpis", tables, params).first().accounts == 3
    with pytest.raises(KeyError):
        run_query("q99", tables, params)


def test_only_one_period(params):
    with pytest.raises(ValueError):
        type(params)(params.period_start, params.period_end, 90, period_id=2)
    with pytest.raises(ValueError):
        type(params)(params.period_end, params.period_start)


def test_checks_agree_across_layers(spark, journey, params):
    """Portfolio counts, measures and facts tell the same story."""
    tables = journey.tables(spark)
    kpis = run_query("q01_global_kpis", tables, params).first()
    cards = measures(Star(tables, params), ["comptes", "comptes_actifs", "comptes_jamais_alimentes", "encours", "echecs"]).first()
    assert (cards.comptes, cards.comptes_actifs, cards.comptes_jamais_alimentes) == (3, 1, 1)
    assert cards.encours == kpis.total_balances
    assert cards.echecs == tables.operation_log().where(F.col("status") == "FAILED").count()
