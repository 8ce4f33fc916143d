"""Pure ``Column -> Column`` expressions; everything stays inside whole-stage codegen."""

from terrier.functions.expressions import *  # noqa: F401,F403
