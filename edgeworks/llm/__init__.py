"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Tasks that run Python
import it on the workers, so a cluster needs it installed (or sent along with
``--py-files``) together with numpy, pyarrow and the tokenizer libraries.
"""
