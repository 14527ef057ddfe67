from newsflow.__main__ import main
from newsflow.operators import store as S
from test_collect import _pages


def test_cli_collect_and_process(spark, tmp_path, capsys):
    pages = str(tmp_path / "pages")
    _pages(spark).write.parquet(pages)
    store = str(tmp_path / "store")
    main(["collect", "--pages", pages, "--store", store, "--json", str(tmp_path / "json")])
    assert "added" in capsys.readouterr().out
    main(["process", "--store", store, "--generate", "newsflow.plans.stub:stub_generate"])
    st = S.read_store(spark, store)
    assert st.count() > 0 and st.where("status = 'raw'").count() == 0
    assert spark.read.json(str(tmp_path / "json")).count() > 0
