from harborline.plans import validate


def test_exit_code_follows_the_checks(spark):
    report = lambda *s: spark.createDataFrame([("c", f"n{i}", x) for i, x in enumerate(s)], "category string, name string, status string")
    assert validate.summary(report("PASS", "WARN")) == (["[PASS] c: n0", "[WARN] c: n1", "PASS 1, WARN 1, INFO 0, FAIL 0"], 0)
    assert validate.summary(report("PASS", "FAIL"))[1] == 1


def test_command(spark, capsys):
    code = validate.main(["/root/testdata/sf0.001"])
    out = capsys.readouterr().out.strip().splitlines()
    assert code == int(any(line.startswith("[FAIL]") for line in out)) and out[-1].startswith("PASS ")
    assert validate.main([]) == 2
