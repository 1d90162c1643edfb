"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from foliospark.llm.chat import OP8_SQL, op8_chat
from foliospark.llm.decontam import OP1_SQL, op1_decontaminate
from foliospark.llm.licenses import OP3_SQL, op3_license
from foliospark.llm.mixing import OP7_SQL, op7_mix
from foliospark.llm.quality import op9_quality
from foliospark.llm.secrets import op4_secrets
from foliospark.llm.sharding import OP5_SQL, op5_shard
from foliospark.llm.simhash import op6_simhash
from foliospark.llm.topk import OP2_SQL, op2_topk
from foliospark.llm.toxicity import op10_toxicity

QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_topk, op3_license, op4_secrets, op5_shard, op6_simhash, op7_mix, op8_chat, op9_quality, op10_toxicity)}
SQL = {"op1_decontaminate": OP1_SQL, "op2_topk": OP2_SQL, "op3_license": OP3_SQL, "op5_shard": OP5_SQL, "op7_mix": OP7_SQL, "op8_chat": OP8_SQL}
