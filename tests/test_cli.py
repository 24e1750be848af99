from tierwise.__main__ import main


def test_cli_run(spark, scratch, capsys):
    code = main(["run", "--root", f"{scratch}/star", "--customers", "60", "--products", "12",
                 "--transactions", "900", "--gold", "9000", "--silver", "6000"])
    out = capsys.readouterr().out
    assert code == 0, out
    assert "validation: PASS" in out and "updated" in out
    assert main(["process", "--root", f"{scratch}/star", "--gold", "9000", "--silver", "6000"]) == 0
    assert "updated 0 customers" in capsys.readouterr().out


def test_cli_custom_tiers(spark, scratch, capsys):
    root = f"{scratch}/star"
    assert main(["generate", "--root", root, "--customers", "40", "--products", "10", "--transactions", "600"]) == 0
    capsys.readouterr()
    assert main(["process", "--root", root, "--tiers", "PLATINUM:12000,GOLD:9000,SILVER:6000",
                 "--base-tier", "BRONZE"]) == 0
    out = capsys.readouterr().out
    assert "PLATINUM" in out and "BRONZE" in out
