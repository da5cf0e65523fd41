from millrace.sources.readers import *  # noqa: F401,F403
from millrace.storage import scratch_dir, scratch_root  # noqa: F401
from millrace.sources.tables import Tables, register  # noqa: F401
from millrace.sources.writers import *  # noqa: F401,F403
