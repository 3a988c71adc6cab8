from sievepoint.sources.readers import *  # noqa: F401,F403
from sievepoint.sources.sinks import *  # noqa: F401,F403
