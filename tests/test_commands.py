import json
import os

from terrace.__main__ import main
from terrace.sources.gold import read_gold

DAY = "2024-01-15"
HOSPITAL = "sciensano/covid_hospitalizations"


def call(capsys, *argv):
    status = main(argv)
    return status, json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_from_dropped_files_to_a_registered_gold_table(spark, tmp_path, capsys):
    drop, bronze, silver, gold = (str(tmp_path / z) for z in ("drop", "bronze", "silver", "gold"))
    records = [{"DATE": DAY, "PROVINCE": p, "REGION": "Flanders", "TOTAL_IN": n, "TOTAL_IN_ICU": 1,
                "NEW_IN": 2, "NEW_OUT": 1} for p, n in (("Coast", 4), ("Limburg", 6), ("Limburg", 6))]
    shots = [{"DATE": DAY, "REGION": "Flanders", "AGEGROUP": "25-34", "DOSE": "A", "COUNT": 3}]
    files = {
        HOSPITAL: json.dumps(records),
        "sciensano/covid_vaccinations": json.dumps(shots),
        "who/global_covid": "Date_reported,Country_code,Country,WHO_region,New_cases,"
                            "Cumulative_cases,New_deaths,Cumulative_deaths\n"
                            f"{DAY},PT,Portugal,EURO,41,812000,3,4060\n",
    }
    for source, text in files.items():
        os.makedirs(f"{drop}/{source}")
        with open(f"{drop}/{source}/data", "w", encoding="utf-8") as out:
            out.write(text)

    status, landed = call(capsys, "land", "--drop", drop, "--bronze", bronze, "--run-date", DAY)
    assert status == 1  # three of the six sources were not dropped
    assert sorted(r["source"] for r in landed if r["status"] == "success") == sorted(files)
    for source in files:
        status, done = call(capsys, "silver", "--source", source, "--bronze", bronze,
                            "--silver", silver, "--run-date", DAY)
        assert status == 0 and done["source"] == source
    status, checked = call(capsys, "check", "--source", HOSPITAL, "--silver", silver)
    assert (status, checked["summary"]) == (0, f"[{HOSPITAL}] Quality: 4/4 checks passed")
    status, built = call(capsys, "gold", "--silver", silver, "--gold", gold, "--checked")
    assert (status, built["be_hospitalizations_summary"]) == (0, 1)
    assert read_gold(spark, gold, "be_hospitalizations_summary").first()["total_hospitalized"] == 10
    status, names = call(capsys, "register", "--database", "commands_test", "--zone", gold)
    assert (status, len(names)) == (0, 3)
    assert spark.table("commands_test.who_global_trends").first()["case_fatality_rate"] == 0.5
    spark.sql("DROP DATABASE commands_test CASCADE")

    again = str(tmp_path / "again")
    status, runs = call(capsys, "incremental", "--source", HOSPITAL, "--bronze", bronze,
                        "--silver", again, "--checkpoint", str(tmp_path / "seen"))
    assert (status, runs[0]["rows_written"]) == (0, 2)
