"""The builders on a small star with every awkward case; expected rows are written out."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medoria.plans import dimensions, facts, questions
from medoria.sources.silver import SILVER_COLUMNS
from medoria.specs import STAR, SchemaMismatch, conform

D = dt.date
AS_OF = D(2021, 3, 1)

ROWS = {
    "communes": ("code_commune string, code_region int", [
        ("01001", 1), ("2A004", 2), ("2A004", 2), ("99999", 7), ("75056", None),
    ]),
    "region": ("code_region int, region string, iso string", [(1, "Ain", "AI"), (2, "Corse", "CO")]),
    "patient": ("id_patient int, sexe string, date_naissance date", [
        (1, "F", D(2000, 2, 29)), (2, "M", D(2000, 3, 1)), (3, "F", D(2000, 3, 2)), (4, "M", None),
        (1, "F", D(2000, 2, 29)), (5, "M", D(2000, 3, 1)),
    ]),
    "deces": ("date_deces date, code_commune string", [
        (D(2019, 5, 1), "01001"), (D(2019, 5, 1), "01001"), (D(2019, 1, 1), "2A004"),
        (D(2019, 7, 1), "00000"), (None, "01001"), (D(2018, 1, 1), "01001"),
    ]),
    "consultations": ("id_prof_sante string, id_patient int, date date, code_diag string, motif string", [
        ("p0", 1, D(2019, 1, 1), "A", "x"), ("p1", 1, D(2019, 2, 1), "A", "y"),
        ("p2", 2, D(2019, 3, 1), "A", "z"), ("p2", 2, D(2019, 12, 31), "B", "z"),
        ("p2", 3, D(2020, 1, 1), "B", "y"), ("p9", 3, D(2019, 6, 1), "B", "z"),
        ("p1", 1, D(2019, 2, 2), "C", None),
    ]),
    "diagnostic": ("code_diag string, diagnostic string", [("A", "Angine"), ("B", "Bosse"), ("Z", "Zona")]),
    "activite_professionel": ("id_prof_sante string, id_etablissement string", [
        ("p1", "e1"), ("p2", "e2"), ("p2", "e1"),
    ]),
    "professionnel_sante": (
        "id_prof_sante string, nom string, prenom string, civilite string, profession string, specialite string",
        [("p0", "N0", "P", "M", "med", "gen"), ("p1", "N1", "P", "MME", "med", "card"),
         ("p2", "N2", "P", "M", "inf", None), ("p2", "N2", "P", "M", "inf", None)],
    ),
    "etablissement_sante": ("id_etablissement string, raison_sociale string, code_commune string, finess string", [
        ("e2", "Deux", "2A004", "f1"), ("e1", "Un", "01001", "f1"), ("e3", "Trois", "99999", "f3"),
    ]),
    "hospitalisation": ("id_patient int, id_etablissement string, code_diag string, date date, duree int", [
        (1, "e1", "A", D(2019, 1, 5), 3), (1, "e1", "H", D(2019, 2, 5), None), (77, "e1", "A", D(2019, 2, 6), 4),
        (5, "e2", "A", D(2020, 2, 6), 5),
    ]),
    "satisfaction_esatis": (
        "finess string, score_all_rea_ajust string, nb_rep_score_all_rea_ajust string, taux_reco_brut string",
        [("f1", "72,5", "10", "50"), ("f3", "80", "30", "0,5"), ("f3", "", "5", None), ("unknown", "60.5", "0", "1")],
    ),
    "satisfaction_esatisca": (
        "finess string, score_all_ajust double, nb_rep_score_all_ajust int, taux_reco_brut double",
        [("f1", 77.5, 30, 40.0)],
    ),
}


@pytest.fixture(scope="module")
def t(spark):
    assert {k: len(v) for k, v in SILVER_COLUMNS.items()} == {
        k: schema.count(",") + 1 for k, (schema, _) in ROWS.items()
    }
    extra = {"conversion_timestamp": F.current_timestamp(), "table_name": F.lit("x")}
    return {name: spark.createDataFrame(rows, schema).withColumns(extra) for name, (schema, rows) in ROWS.items()}


@pytest.fixture(params=["broadcast", "shuffled"])
def either_way(request):
    if request.param == "shuffled":
        request.getfixturevalue("never_broadcast")


def rows(df, *columns):
    found = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in found.collect()), key=repr)


def expect(*expected):
    return sorted(expected, key=repr)


def test_dim_lieu(t, either_way):
    assert rows(dimensions.dim_lieu(t)) == expect(
        (1, "01001", "Ain", "AI"), (2, "2A004", "Corse", "CO"), (3, "75056", None, None), (4, "99999", None, None)
    )


def test_dim_patient(t):
    assert rows(dimensions.dim_patient(t, AS_OF)) == expect(
        (1, 21, "F", 2000, D(2000, 2, 29)), (2, 21, "M", 2000, D(2000, 3, 1)),
        (3, 20, "F", 2000, D(2000, 3, 2)), (4, None, "M", None, None), (5, 21, "M", 2000, D(2000, 3, 1)),
    )


def test_dim_date(t):
    days = dimensions.dim_date(t, [2020, 2021])
    assert (20200000, None, 2020, None, None, None, None) in rows(days)
    assert (20190701, D(2019, 7, 1), 2019, 7, 1, 3, 2) in rows(days)
    assert days.where("date_complete is null").count() == 2
    assert days.count() == days.select("date_id").distinct().count()


def test_dim_etablissement(t, either_way):
    assert rows(dimensions.dim_etablissement(t)) == expect(
        ("e1", "Un", "01001", "Ain", "f1"), ("e2", "Deux", "2A004", "Corse", "f1"),
        ("e3", "Trois", "99999", None, "f3"),
    )


def test_dim_diagnostic_has_one_row_per_code(t, either_way):
    assert rows(dimensions.dim_diagnostic(t)) == expect(
        ("A", "Angine", "x"),  # three reasons, one each: the smallest
        ("B", "Bosse", "z"),
        ("C", None, None),
        ("H", None, None),  # only known from a stay
    )


def test_bridge_diagnostic_motif_keeps_all_reasons(t, either_way):
    assert rows(dimensions.bridge_diagnostic_motif(t)) == expect(
        ("A", "Angine", "x"), ("A", "Angine", "y"), ("A", "Angine", "z"),
        ("B", "Bosse", "z"), ("B", "Bosse", "y"), ("C", None, None),
    )


def test_dim_professionel(t):
    found = rows(dimensions.dim_professionel(t), "professionnel_id", "nom", "specialite")
    assert found == expect(("p0", "N0", "gen"), ("p1", "N1", "card"), ("p2", "N2", None))


def test_dim_indicateur(spark):
    assert rows(dimensions.dim_indicateur(spark)) == expect((1, "esatis48h"), (2, "esatisca"))


def test_fait_deces(t, either_way):
    assert rows(facts.fait_deces(t, dimensions.dim_lieu(t))) == expect(
        (1, None, 1, 1, None),
        (2, 20180101, 1, 1, 2018),
        (3, 20190101, 2, 1, 2019),
        (4, 20190501, 1, 1, 2019),
        (5, 20190501, 1, 1, 2019),
        (6, 20190701, None, 1, 2019),
    )


def test_text_that_is_no_date_or_number_becomes_null(spark):
    stays = spark.createDataFrame(
        [("x", "e1", "A", "not a day", "many"), ("2", "e1", "A", "2019-01-05", "3")],
        "id_patient string, id_etablissement string, code_diag string, date string, duree string",
    )
    assert rows(facts.fait_hospitalisation({"hospitalisation": stays})) == expect(
        (None, "e1", "A", None, None, 1, None), (2, "e1", "A", 20190105, 3, 1, 2019)
    )


def test_fait_hospitalisation(t):
    assert rows(facts.fait_hospitalisation(t)) == expect(
        (1, "e1", "A", 20190105, 3, 1, 2019), (1, "e1", "H", 20190205, None, 1, 2019),
        (77, "e1", "A", 20190206, 4, 1, 2019), (5, "e2", "A", 20200206, 5, 1, 2020),
    )


def test_fait_satisfaction(t, either_way):
    places = dimensions.dim_etablissement(t)
    assert rows(facts.fait_satisfaction(t, places, 2020)) == expect(
        ("e1", 1, 20200000, 72.5, 10, 50.0),  # two establishments share f1
        ("e3", 1, 20200000, 80.0, 30, 0.5),
        ("e3", 1, 20200000, None, 5, None),
        (None, 1, 20200000, 60.5, 0, 1.0),
        ("e1", 2, 20200000, 77.5, 30, 40.0),
    )


def test_fait_consultations_keeps_the_number_of_rows(t, either_way):
    fact = facts.fait_consultations(t)
    assert rows(fact, "fk_professionnel", "fk_date_consultation", "fk_etablissement") == expect(
        ("p0", 20190101, None), ("p1", 20190201, "e1"), ("p1", 20190202, "e1"), ("p2", 20190301, "e1"),
        ("p2", 20191231, "e1"), ("p2", 20200101, "e1"), ("p9", 20190601, None),
    )


def test_bridge_repeats_per_establishment(t, either_way):
    bridge = facts.bridge_consultation_etablissement(t)
    assert bridge.count() == 10
    assert bridge.where("fk_professionnel = 'p2' and fk_etablissement = 'e2'").count() == 3


def test_all_builders_keep_their_contract(t, spark):
    places, owners = dimensions.dim_lieu(t), dimensions.dim_etablissement(t)
    built = {
        "dim_lieu": places,
        "dim_patient": dimensions.dim_patient(t, AS_OF),
        "dim_date": dimensions.dim_date(t),
        "dim_etablissement": owners,
        "dim_diagnostic": dimensions.dim_diagnostic(t),
        "dim_indicateur": dimensions.dim_indicateur(spark),
        "dim_professionel": dimensions.dim_professionel(t),
        "fait_deces": facts.fait_deces(t, places),
        "fait_hospitalisation": facts.fait_hospitalisation(t),
        "fait_satisfaction": facts.fait_satisfaction(t, owners),
        "fait_consultations": facts.fait_consultations(t),
    }
    assert set(built) == set(STAR)
    for name, df in built.items():
        spec = STAR[name]
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spec.schema]
        if spec.key:
            keys = df.select(spec.key)
            assert keys.where(F.col(spec.key).isNull()).isEmpty()
            assert keys.count() == keys.distinct().count()


def test_conform_refuses_other_columns(spark):
    with pytest.raises(SchemaMismatch, match="libelle_indicateur"):
        conform(spark.range(1).withColumnRenamed("id", "indicateur_id"), STAR["dim_indicateur"])


YEAR_2019 = (D(2019, 1, 1), D(2020, 1, 1))


def test_consultation_rate(t):
    fact = facts.fait_consultations(t)
    rates = rows(questions.consultation_rate(fact, "fk_etablissement", *YEAR_2019))
    assert rates == expect(("e1", 4, 0.666667, 2.0), (None, 2, 0.333333, 1.0))
    only = questions.consultation_rate(fact, "fk_etablissement", *YEAR_2019, only=["e1"])
    assert rows(only) == [("e1", 4, 0.666667, 2.0)]
    assert questions.consultation_rate(fact, "fk_diagnostic", D(2030, 1, 1), D(2031, 1, 1)).count() == 0


def test_shares_add_up(t):
    fact = facts.fait_consultations(t)
    for by in ("fk_etablissement", "fk_diagnostic", "fk_professionnel"):
        rates = questions.consultation_rate(fact, by, *YEAR_2019)
        assert rates.agg(F.sum("part")).first()[0] == pytest.approx(1, abs=1e-5)


def test_consultation_rate_by_professional(t):
    rates = questions.consultation_rate_by_professional(
        facts.fait_consultations(t), dimensions.dim_professionel(t), *YEAR_2019
    )
    assert rows(rates) == expect(
        ("p0", 1, 0.166667, 1.0, "med", "gen"), ("p1", 2, 0.333333, 2.0, "med", "card"),
        ("p2", 2, 0.333333, 2.0, "inf", None), ("p9", 1, 0.166667, 1.0, None, None),
    )


def test_hospitalisation_rates(t):
    fact, people = facts.fait_hospitalisation(t), dimensions.dim_patient(t, AS_OF)
    assert rows(questions.hospitalisation_rate(fact, people, *YEAR_2019)) == [(2, 0.4, 3)]
    assert rows(questions.hospitalisation_rate(fact, people, D(2030, 1, 1), D(2031, 1, 1))) == [(0, 0.0, 0)]
    assert rows(questions.hospitalisation_by(fact, "fk_diagnostic", *YEAR_2019)) == expect(
        ("A", 2, 0.666667, 7), ("H", 1, 0.333333, None)
    )


def test_hospitalisation_by_sex_and_age(t):
    fact, people = facts.fait_hospitalisation(t), dimensions.dim_patient(t, AS_OF)
    assert rows(questions.hospitalisation_by_patient(fact, people)) == expect(
        ("F", 21, "sexe_age", 1, 1, 1.0), ("F", 20, "sexe_age", 1, 0, 0.0), ("M", 21, "sexe_age", 2, 1, 0.5),
        ("M", None, "sexe_age", 1, 0, 0.0), ("F", None, "sexe", 2, 1, 0.5), ("M", None, "sexe", 3, 1, 0.333333),
        (None, 20, "age", 1, 0, 0.0), (None, 21, "age", 3, 2, 0.666667), (None, None, "age", 1, 0, 0.0),
    )
    by_sex = questions.hospitalisation_by_patient(fact, people, ["sexe"])
    assert rows(by_sex) == expect(("F", "sexe", 2, 1, 0.5), ("M", "sexe", 3, 1, 0.333333))


def test_deaths_by_region(t):
    places = dimensions.dim_lieu(t)
    deaths = questions.deaths_by_region(facts.fait_deces(t, places), places, 2019)
    assert rows(deaths) == expect(("Ain", 2), ("Corse", 1), (None, 1))


def test_satisfaction_by_region(t):
    places = dimensions.dim_etablissement(t)
    found = questions.satisfaction_by_region(facts.fait_satisfaction(t, places, 2020), places, 2020)
    assert rows(found) == expect(
        ("Ain", 76.25, 75.0, 40),
        (None, 80.0, 70.25, 35),  # e3 without region and the unknown finess; no answers weigh nothing
    )
