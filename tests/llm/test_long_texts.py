"""Very long texts without any break are read in time proportional to their length."""

import time

import numpy as np
import pytest

from folioforge.llm import markup, mojibake, pairs, residue, scan_noise, unicode_form

L = 20_000
TEXTS = {"words": "word " * L, "html": "<b>x</b> " * L, "one": "a" * 5 * L, "latin": "é" * 3 * L, "mixed": "мир é " * L, "lines": "line of text\n" * L, "under": "_a " * L, "star": "*a " * L, "dollar": "$a " * L, "brack": "[a " * L, "command": "\\a{b " * L, "entity": "&amp " * L, "equals": "= a\n" * L}
MODELS = residue.Models(np.zeros((1 << 18, 3), np.float32), 0.1, np.zeros(1 << 18, np.float32), np.zeros(1 << 18, np.float32))
READ = {
    "markup": lambda t: markup.write(markup.read_tree(t)),
    "scan": lambda t: scan_noise.repair_text(t, {}, set()),
    "characters": unicode_form.changes,
    "encoding": lambda t: mojibake.Repairer(mojibake.log_probabilities(mojibake.general_pairs())).repair(t),
    "clauses": pairs.clauses,
    "residue": lambda t: residue.residue_shares([t], MODELS, residue.ResiduePlan()),
    "placeholders": lambda t: residue.placeholder_rows([t], MODELS, residue.ResiduePlan()),
}


@pytest.mark.parametrize("read", READ)
def test_in_proportion(read):
    for text in TEXTS.values():
        began = time.process_time()
        READ[read](text)
        assert time.process_time() - began < 5
