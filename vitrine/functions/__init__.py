from vitrine.functions.clean import *  # noqa: F401,F403
from vitrine.functions.calendar import *  # noqa: F401,F403
