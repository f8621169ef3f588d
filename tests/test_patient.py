import random

from tabloom.operators import profile
from tabloom.plans import patient
from tabloom.sources import schemas, tables


def write_patients(path, rows=240):
    rng = random.Random(11)
    with open(path, "w") as f:
        f.write(",".join(schemas.PATIENT_SCHEMA.names) + "\n")
        for _ in range(rows):
            sick = rng.random() < 0.35
            glucose = int(rng.gauss(145 if sick else 105, 18))
            bmi = round(rng.gauss(35 if sick else 30, 4), 1)
            age = rng.randint(21, 70)
            f.write(f"{rng.randint(0, 12)},{glucose},{rng.randint(50, 90)},20,0,{bmi},0.4,{age},{int(sick)}\n")


def test_patient_study(spark, tmp_path):
    path = str(tmp_path / "patients.csv")
    write_patients(path)
    study = patient.read_study(spark, path)
    assert sorted(r["row"] for r in study.table.select("row").collect()) == list(range(240))
    summary = {r["feature"]: r for r in profile.describe(study.table, (*study.features, study.label)).collect()}
    assert len(summary) == 9 and summary["Insulin"]["max"] == 0.0 and summary["Age"]["n"] == 240

    train, test = patient.scaled_sides(study)
    logit = patient.fit_balanced_logit(train, study.features, study.label)
    scores = {r["metric"]: r["value"] for r in patient.report(study, logit.apply(test)).collect()}
    assert scores["auc"] > 0.8 and scores["recall"] > 0.6

    forest = patient.fit_forest(train, study, balance=True)
    table = patient.permutation_table(study, train, forest, repeats=3).collect()
    assert table[0]["feature"] == "Glucose" and len(table) == 8

    dependence = patient.dependence_table(study, train, logit, points=20)
    glucose = [r["mean_probability"] for r in dependence.filter("feature = 'Glucose'").orderBy("grid").collect()]
    assert glucose == sorted(glucose) and len(glucose) == 20


def test_types_of_a_csv_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "patients.csv")
    write_patients(path)
    assert tables.inferred_schema(spark, path) == schemas.PATIENT_SCHEMA
    assert tables.read_csv(spark, path).collect() == tables.read_csv(spark, path, schemas.PATIENT_SCHEMA).collect()

    odd = tmp_path / "odd.csv"
    odd.write_text(
        "whole,wide,real,flag,day,word,none,late,a.b,text 1\n"
        '1,5,1.5,true,2020-01-02,1d,,1,7,"a,b"\n'
        ",3000000000,-2e3,FALSE,2020-01-02 03:04:05,2,,2,8,\n"
        "-3,7,4,true,2021-12-31T00:00:00,3,,x,9,c\n"
    )
    assert tables.read_csv(spark, str(odd)).dtypes == [
        ("whole", "int"), ("wide", "bigint"), ("real", "double"), ("flag", "boolean"), ("day", "timestamp"),
        ("word", "string"), ("none", "string"), ("late", "string"), ("a.b", "int"), ("text 1", "string"),
    ]
    odd.write_text("a,b\n")
    assert tables.read_csv(spark, str(odd)).dtypes == [("a", "string"), ("b", "string")]
