from eventloom.functions.strings import key_label, path_stem, split_whitespace

__all__ = ["key_label", "path_stem", "split_whitespace"]
