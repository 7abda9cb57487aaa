"""DataFrame -> DataFrame operators shared by batch jobs and micro-batches."""
