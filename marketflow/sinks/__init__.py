"""Outputs. A sink that runs inside ``foreachBatch`` writes below the batch id, so a repeated batch replaces itself."""
