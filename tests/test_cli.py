"""The command line, in this process."""

import sample_logs as sl

from logtrail.__main__ import main


def test_merge_unmerge_and_reports(spark, tmp_path, capfd):
    inbox, store = tmp_path / "in", str(tmp_path / "store")
    full = sl.plain_log(sl.log_hash(7))
    sl.write_log(inbox, "a.azm", {t: full[t] for t in ("logs", "signalling", "location")})
    base = ["--azm_file", str(inbox), "--store", store, "--namespace", "all_logs"]
    assert main([*base, "--get_schema_shasum_and_exit"]) == 0
    assert main([*base, "--dry"]) == 0
    assert main([*base, "--unmerge"]) == 1
    assert "empty_target" in capfd.readouterr().out
    hook = tmp_path / "hook.py"
    hook.write_text("def preprocess(df, table):\n    return df\n")
    assert main([*base, "--only_tables", "signalling", "--call_preprocess_func_in_module_before_import", str(hook)]) == 0
    assert main(base) == 1
    assert "already_merged" in capfd.readouterr().out
    (inbox / "bad.azm").write_bytes(b"nope")
    assert main([*base, "--unmerge", "--purge"]) == 1
    out = capfd.readouterr().out
    assert "unmerged" in out and "unreadable" in out
