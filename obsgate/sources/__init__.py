"""Line sources and the fixed file/layout/unit registries."""
