"""The command-line jobs end to end on the small tables."""

from __future__ import annotations

import numpy as np

from ridgeway.cli import main
from ridgeway.model import LinearModel
from ridgeway.operators.gd import GDConfig, train_gd
from ridgeway.session import scratch_path
from ridgeway.sources.tables import HINGE_FEATURES, class_rows, hinge_rows, log_rows
from ridgeway.sources.text import read_weight_record, write_labelled_text, write_weight_lines
from tests.conftest import SF_SMALL


def test_gd_job_reads_text_and_writes_a_record(spark):
    rows_path = scratch_path(spark, "cli-rows")
    write_labelled_text(log_rows(spark, SF_SMALL), rows_path, "y", ["x1", "x2", "x3"], "\t")
    init_path = scratch_path(spark, "cli-init")
    write_weight_lines(LinearModel.from_vector([0.1, 0.0, 0.0, 0.0]).to_table(spark), init_path)
    out = scratch_path(spark, "cli-out")
    main(["gd", "--loss", "logistic", "--input", rows_path, "--n-features", "3", "--init-weights", init_path,
          "--lr", "0.2", "--tol", "1e-4", "--output", out, "--format", "record"])
    got = LinearModel.from_table(read_weight_record(spark, out)).vector()
    want = train_gd(log_rows(spark, SF_SMALL), ["x1", "x2", "x3"], "y",
                    GDConfig(loss="logistic", lr=0.2, tol=1e-4), init=[0.1, 0.0, 0.0, 0.0]).model.vector()
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-12)


def test_sgd_and_score_jobs(spark):
    emb = scratch_path(spark, "cli-emb")
    class_rows(spark, SF_SMALL).write.parquet(emb)
    model = scratch_path(spark, "cli-model")
    main(["sgd", "--kind", "softmax", "--input", emb, "--features", "features", "--label", "label",
          "--alpha", "0.05", "--l", "0", "--max-iter", "1", "--output", model])
    scored = scratch_path(spark, "cli-scored")
    main(["score", "--model", model, "--input", emb, "--features", "features", "--output", scored])
    out = spark.read.parquet(scored)
    assert {"scores", "probs", "prediction"} <= set(out.columns)
    assert out.count() == class_rows(spark, SF_SMALL).count()
    cust = scratch_path(spark, "cli-cust")
    hinge_rows(spark, SF_SMALL).write.parquet(cust)
    hm = scratch_path(spark, "cli-hinge")
    main(["sgd", "--kind", "hinge", "--input", cust, "--features", *HINGE_FEATURES, "--label", "y",
          "--max-iter", "2", "--output", hm])
    hs = scratch_path(spark, "cli-hscored")
    main(["score", "--model", hm, "--input", cust, "--features", *HINGE_FEATURES, "--output", hs])
    assert "score" in spark.read.parquet(hs).columns


def test_gd_job_resumes_from_its_log(spark):
    rows_path = scratch_path(spark, "cli-log-rows")
    write_labelled_text(log_rows(spark, SF_SMALL), rows_path, "y", ["x1", "x2", "x3"], ",")
    log = scratch_path(spark, "cli-log")
    base = ["gd", "--loss", "logistic", "--input", rows_path, "--n-features", "3", "--sep", ",",
            "--lr", "0.5", "--tol", "1e-4", "--log", log, "--format", "record"]
    main(base + ["--max-epochs", "3", "--output", scratch_path(spark, "cli-log-out1")])
    out = scratch_path(spark, "cli-log-out2")
    main(base + ["--max-epochs", "7", "--output", out])
    got = LinearModel.from_table(read_weight_record(spark, out)).vector()
    want = train_gd(log_rows(spark, SF_SMALL), ["x1", "x2", "x3"], "y",
                    GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=7)).model.vector()
    np.testing.assert_allclose(got, want, rtol=1e-10, atol=1e-13)
