"""Command line: ``python -m loomset prepare --config job.yaml`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import importlib
import logging
from collections.abc import Callable

from loomset.operators.comparing import BASE, TUNED
from loomset.params import JobParams
from loomset.plans.evaluate import evaluate
from loomset.plans.explore import explore
from loomset.plans.prepare import prepare
from loomset.plans.training import training_text
from loomset.session import build_session
from loomset.sources.reader import load_rows


def _factory(spec: str) -> Callable:
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loomset")
    parser.add_argument("job", choices=("prepare", "training-text", "evaluate", "explore"))
    parser.add_argument("--config", required=True, help="YAML or JSON file")
    parser.add_argument("--force", action="store_true", help="redo finished stages")
    parser.add_argument("--base", help="module:function making the base model's generator")
    parser.add_argument("--tuned", help="module:function making the tuned model's generator")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    params = JobParams.from_file(args.config)
    if params.ignored:
        logging.info("Sections for the trainer, not used here: %s", ", ".join(params.ignored))
    spark = build_session()
    if args.job == "prepare":
        prepare(spark, params.dataset, args.force).groupBy("split").count().show()
    elif args.job == "training-text":
        for name, text in training_text(spark, params.dataset).items():
            logging.info("%s: %d rows", name, text.count())
    elif args.job == "evaluate":
        if not (args.base and args.tuned):
            parser.error("evaluate needs --base and --tuned")
        generators = {BASE: _factory(args.base), TUNED: _factory(args.tuned)}
        evaluate(spark, params, generators, force=args.force).comparison.show()
    else:
        rows = load_rows(spark, params.dataset.name_or_path, params.dataset.schema)
        profile = explore(
            rows,
            params.dataset.key,
            system_prompt=params.dataset.system_prompt,
            template=params.dataset.chat_template,
        )
        logging.info("%d rows", profile.rows)
        profile.word_lengths.show()
        profile.preview.show(truncate=False)


if __name__ == "__main__":
    main()
