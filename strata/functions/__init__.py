from strata.functions.compat import *  # noqa: F401,F403
