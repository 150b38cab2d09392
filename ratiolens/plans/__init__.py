"""The three runs: learn bounds, detect, analyse."""
