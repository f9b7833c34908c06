"""What the layers contain and the jobs that fill them."""
