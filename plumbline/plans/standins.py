"""Stand-ins for a model, so that the hooks run without one."""

from __future__ import annotations

import hashlib
import sys

from pyspark import cloudpickle

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def digest_model(model: str):
    """Answers with a short digest of model, variant and prompt."""

    def generate(prompts, variant):
        return [hashlib.md5(f"{model}|{variant}|{p}".encode()).hexdigest()[:12] for p in prompts]

    return generate


def length_scorer(model: str):
    """Each token costs its length and that of the model's name."""

    def score(prompts, completions):
        for prompt, completion in zip(prompts, completions):
            tokens = f"{prompt}\n{completion}".split()
            yield len(prompt.split()), [-(len(t) + len(model)) for t in tokens]

    return score
