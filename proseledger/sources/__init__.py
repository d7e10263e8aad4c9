"""Reading, writing, column roles, synthetic columns and the cluster's shared folder."""
